"""Spark-native engine for document-digitisation workloads.

Every operator is ``DataFrame -> DataFrame`` or ``Column -> Column``; nothing
here starts a session of its own except :func:`quirework.session.local_session`,
which tests, the benchmark and the command line use.
"""

__version__ = "0.1.0"
