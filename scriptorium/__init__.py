"""Document review over corpora as a set of lazy Spark DataFrame transformations."""
