"""Operations for large training-data pipelines.

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and their SQL.
"""
