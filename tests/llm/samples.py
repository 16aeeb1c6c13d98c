"""Small frames with the cases that every operator must bear."""

import random

LONG = "word " * 30_000 + "end"
TEXTS = [None, "", " ", "\n\t ", "a", "a ", " a  b ", "Hello world, it's   fine.\n\n", "漢字 です é<|endoftext|> x", "🙂 🙂🙂", LONG,
         "▁", "a▁b ▁ c", "the same text", "the same text"]


def documents(spark, texts=TEXTS, **columns):
    """doc_id, text and columns that clash with names used inside the operators; repeated rows and a null id."""
    rows = [(i, t, "en" if i % 2 else None, "src", 3) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "without an id", None, None, None)] if rows else []
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    for name in ("row", "number", "fp", "u", "v", "ids", "score", "key", "label", "by", "size", "digest", "host", "vec_id"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def no_documents(spark):
    return documents(spark).where("false")


def prose(seed, words=60, vocabulary=400, letters="abcdefghijklmnop"):
    pick = random.Random(seed)
    known = ["".join(pick.choice(letters) for _ in range(pick.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(pick.choice(known) for _ in range(words))
