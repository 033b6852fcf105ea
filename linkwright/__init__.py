"""linkwright: record linkage and corpus preparation as PySpark DataFrame operators."""
