"""cargoloom: logistics warehousing as plain ``DataFrame -> DataFrame`` functions on Spark."""
