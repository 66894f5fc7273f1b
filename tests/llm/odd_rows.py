#: Nulls, empty texts, white space, repeated rows, ties, a long text.
ODD = [(None, None), (None, "a b c"), (1, None), (1, ""), (2, " \t\n"), (3, "one"), (3, "one"), (4, "two two\ntwo two\n"), (5, "Üñï ℝ 🙂 " * 40), (6, "word " * 3000), (6, "word " * 3000), (7, "x" * 5000)]
