"""Small tables with odd rows, shared by the operator tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept boolean, `row` string, entities string"

WORDS = "alpha beta gamma delta river stone cloud winter summer paper window garden silver copper market letter".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_texts():
    rng = random.Random(5)
    long_text = "\n".join(sentence(rng, 12) for _ in range(3000))
    base = sentence(rng, 80)
    return [
        None, "", " ", "\n\n", "12 34 !!", "Ünïcödé ▁ mark 😀 漢字\x00 end", "  two  spaces  ", "<|endoftext|> kept as text",
        base, base.upper(), base, base + " tail", sentence(rng, 3), "one", long_text, "x" * 5000, "a\r\nb\tc\x0bd",
        *[sentence(rng, rng.randint(1, 200)) for _ in range(30)],
    ]


def odd_documents(spark, texts=None):
    texts = odd_texts() if texts is None else texts
    langs = [None, "en", "de"]
    rows = [(i, t, langs[i % 3], None, None, 1, None, "r", "e") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "no id here", "en", "s", 3, None, True, None, None)] if len(rows) > 8 else []
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
