"""Training-data pipeline operators.

Ten operators over document, page and embedding tables (one module each),
``queries.py`` with the registered queries and their SQL, and
``corpus_pipeline.py`` at the repository top.  Nothing else in the package
imports this subpackage.
"""
