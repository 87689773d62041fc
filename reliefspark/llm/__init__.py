"""Training-data operators: text, token, embedding and archive work on the corpus tables.

Nothing else in the library imports this subpackage; its queries are listed in
``reliefspark.llm.queries``.
"""
