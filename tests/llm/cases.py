"""Rows that every operator must take."""

# Nulls, empty and blank texts, repeated rows, ties, a long text, several scripts.
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "no number here"), (None, None),
    (5, "a  b\n\nc\x00 d\tz  "), (6, "日本語 テキスト 😀x ▁▁x"), (7, "Été İstanbul ΑΣ <|endoftext|> don't x²"),
    (8, "word " * 40_000), (9, "x" * 30_000), (10, "same text in two rows"), (11, "same text in two rows"),
]
