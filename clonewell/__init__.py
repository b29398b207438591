"""clonewell: barcoded variant-effect analysis as Spark DataFrame operators."""
