"""Training-data operators (BPE, language ID, top-k search, similarity join, ...).

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered ``opN_*`` queries and their SQL.
"""
