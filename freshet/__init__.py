"""freshet: DataFrame operators for environmental time series and early warning."""
