"""Operators for preparing text corpora as training data.

One module per operator; ``queries`` registers the thin ``opN_*`` queries,
``oracle`` their SQL. Nothing outside this subpackage imports it.

Shared conventions: rows are whole documents, ``text`` may be null; the
operators read only the columns they name, so extra or clashing columns are
harmless; words are runs of anything but space and ``\\t\\n\\v\\f\\r``.
"""
