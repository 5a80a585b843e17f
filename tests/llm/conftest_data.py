"""Rows that every operator must handle: null and empty texts, a null id, a very long text, repeats."""

ODD = [(1, None), (None, "no id here"), (2, ""), (3, "  \n\t "), (4, "word " * 30_000), (5, "same text"), (5, "same text"), (6, "same text")]
