"""valuelens: valuation analytics as Spark DataFrame operators.

Sub-packages: ``sources`` (readers, HTML extraction), ``sinks`` (writers),
``functions`` (column expressions), ``operators`` (table-level operators),
``plans`` (composed flows and the driver query catalogue), ``streaming``
(Structured Streaming jobs).
"""

__version__ = "0.1.0"
