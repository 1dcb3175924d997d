"""Transit ridership and neighbourhood-equity analytics on Spark DataFrames."""
