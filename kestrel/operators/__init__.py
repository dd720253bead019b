"""Feature blocks and the DataFrame-level algorithms behind them."""
