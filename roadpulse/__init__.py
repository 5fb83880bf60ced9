"""Link measures of effectiveness from connected-vehicle observations, as composable Spark DataFrame operators."""
