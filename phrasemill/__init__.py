"""Key-phrase mining over tables of short documents, expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
