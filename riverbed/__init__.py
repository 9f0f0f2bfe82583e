"""riverbed: batch and streaming analytics operators on PySpark.

Subpackages: ``sources`` (inputs), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame operators), ``streaming`` (stateful
processors and the stream runner), ``sinks`` (outputs), ``plans`` (the
registered queries and their SQL oracle). Start sessions with
``riverbed.session.build_session``.
"""

__version__ = "0.1.0"
