"""Fill-in-the-middle: a text is cut at two token boundaries and its parts are put in another order.

Tokens are runs of letters A-Z, a-z and single other characters. A text becomes a sequence of character
classes (other, first letter of a run, later letter of a run) in a wavelet matrix. The number of
tokens that start before a place is the sum of the ranks of the first two classes there, and bisection
on it finds the place after any number of tokens. Only the two places leave Python; Spark cuts
and joins the strings.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.common import unused, whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Out of 100: texts from this number on stay plain, and of the others those below SPM have the suffix first.
PLAIN_FROM, SPM = 90, 20
OTHER, STARTS, INSIDE = 0, 1, 2
#: Code points classified at once, so that a very long text needs little besides itself.
BLOCK = 1 << 18
_WORD = 512
PLACES = T.StructType([T.StructField(n, T.LongType()) for n in ("n", "first", "second")])


class BitVector:
    """Bits with the count of ones before every 512th, so that a rank reads at most 64 bytes."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % (_WORD // 8))).reshape(-1, _WORD // 8)).sum(axis=1)
        self.before = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)]).tolist()
        self.data = packed.tobytes()

    def rank(self, i: int) -> int:
        """Ones among the first ``i`` bits."""
        block, left = divmod(i, _WORD)
        start = block * (_WORD // 8)
        part = int.from_bytes(self.data[start : start + (left + 7) // 8], "little")
        return self.before[block] + (part & ((1 << left) - 1)).bit_count()


class WaveletMatrix:
    """Rank of any symbol of a sequence, one bit vector per bit from the highest on."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.planes = len(symbols), []
        for shift in reversed(range(bits)):
            plane = (symbols >> shift) & 1
            zeros = len(plane) - int(np.count_nonzero(plane))
            self.planes.append((shift, zeros, BitVector(plane)))
            symbols = np.concatenate([symbols[plane == 0], symbols[plane == 1]])

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` is among the first ``i``."""
        low, high = 0, i
        for shift, zeros, ones in self.planes:
            a, b = ones.rank(low), ones.rank(high)
            low, high = (zeros + a, zeros + b) if symbol >> shift & 1 else (low - a, high - b)
        return high - low


def classes(text: str) -> np.ndarray:
    """The class of every code point, as one byte each."""
    out, before = np.empty(len(text), dtype=np.uint8), False
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), dtype="<u4") | 32
        letter = (points >= ord("a")) & (points <= ord("z"))
        inside = letter & np.concatenate([[before], letter[:-1]])
        out[at : at + BLOCK] = letter.astype(np.uint8) + inside
        before = bool(letter[-1])
    return out


class Boundaries:
    """Token boundaries of a text by rank queries on its wavelet matrix."""

    def __init__(self, text: str):
        self.matrix = WaveletMatrix(classes(text), 2)
        self.tokens = self.before(self.matrix.size)

    def before(self, i: int) -> int:
        """Tokens that start among the first ``i`` code points."""
        return self.matrix.rank(OTHER, i) + self.matrix.rank(STARTS, i)

    def after(self, units: int) -> int:
        """The number of code points that the first ``units`` tokens cover."""
        if units >= self.tokens:
            return self.matrix.size
        return bisect_left(range(self.matrix.size + 1), units + 1, key=self.before) - 1


@F.pandas_udf(PLACES)
def _places(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    out = np.zeros((len(text), 3), dtype=np.int64)
    for row, (t, a, b) in enumerate(zip(text, h1, h2, strict=True)):
        marks = Boundaries(t)
        low, high = sorted((int(a) % (marks.tokens + 1), int(b) % (marks.tokens + 1)))
        out[row] = marks.tokens, marks.after(low), marks.after(high)
    return pd.DataFrame(out, columns=PLACES.names)


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the seed and the id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, out: str = "fim", plain_from: int = PLAIN_FROM, spm: int = SPM) -> DataFrame:
    """``docs`` with a struct column ``out``: n (tokens), form, prefix_chars, middle_chars, output.

    Form is ``plain`` (the text itself; both lengths null), ``psm`` or ``spm``. Empty and null texts and texts that hold one
    of the three markers are plain. Very long texts are read whole. Equal rows get equal results,
    rows of one id and other texts the same draws; both cuts may fall on one place, then the middle is empty. An
    empty table gives no rows. A column named ``out`` is replaced, all others stay as they are.
    """
    at = unused(docs, "places")
    whole, h = whole_text(text), draws(F.col(doc_id), seed)
    held = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | whole.contains(marker)
    form = F.when((whole == "") | held | (h[2] % 100 >= plain_from), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    first, second = F.col(f"{at}.first").cast("int"), F.col(f"{at}.second").cast("int")
    prefix = F.concat(F.lit(PREFIX), F.substr(whole, F.lit(1), first))
    middle = F.concat(F.lit(MIDDLE), F.substr(whole, first + 1, second - first))
    suffix = F.concat(F.lit(SUFFIX), F.substr(whole, second + 1, F.lit(2**31 - 1) - second))
    joined = F.when(form == "plain", whole).when(form == "spm", F.concat(suffix, prefix, middle)).otherwise(F.concat(prefix, suffix, middle))
    moved = form != "plain"
    made = F.struct(
        F.col(f"{at}.n").alias("n"), form.alias("form"),
        F.when(moved, F.col(f"{at}.first")).alias("prefix_chars"),
        F.when(moved, F.col(f"{at}.second") - F.col(f"{at}.first")).alias("middle_chars"),
        joined.alias("output"),
    )
    return docs.withColumn(at, _places(whole, h[0], h[1])).withColumn(out, made).drop(at)


def restored(output: Column, form: Column) -> Column:
    """The text before ``fill_in_middle``, from its output and form alone."""
    p, s, m = F.instr(output, PREFIX), F.instr(output, SUFFIX), F.instr(output, MIDDLE)
    k = len(PREFIX)

    def between(a: Column, b: Column) -> Column:
        return F.substr(output, a + k, b - a - k)

    tail = F.substr(output, m + k, F.lit(2**31 - 1) - m - k)
    psm = F.concat(between(p, s), tail, between(s, m))
    spm = F.concat(between(p, m), tail, between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
