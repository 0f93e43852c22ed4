"""tidewire: stream and batch record operators on Spark DataFrames.

Modules: ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame), ``sources``, ``sinks``, ``streaming`` (stream runners and
stateful helpers), ``plans`` (registered queries and end-to-end jobs),
``fixed`` (values that must match the original jobs), ``session``.
"""

__version__ = "0.1.0"

from tidewire import fixed, functions, operators, sinks, sources, streaming  # noqa: E402,F401
