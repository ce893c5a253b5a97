"""framesieve: a PySpark-native engine for mining hard frame triplets and curating training corpora."""

__version__ = "0.1.0"
