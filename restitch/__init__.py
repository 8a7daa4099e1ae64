"""restitch: recovery and curation of archived web content on PySpark."""

__version__ = "0.1.0"
