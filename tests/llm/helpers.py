"""Small tables with the awkward cases that every operator has to take."""

import random

WORDS = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "green", "seven", "north", "paper", "light"]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def awkward_texts() -> list[str | None]:
    """Nulls, empty texts, repeats, near copies, a very long text, odd white space and scripts."""
    base = prose(120, 1)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    return [
        None, "", None, base, base, near, "one", " ", "\n\n", "  two  spaces ", "été\tÀ la carte\n漢字 ▁ x",
        prose(20_000, 2), base + "\n" + prose(40, 3), prose(40, 3) + "\nshort", "short\nshort\n SHORT ",
        "\U0001f600 emoji \U0001f600", base.upper(),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, ids string, tokens string"


def documents(spark, texts=None):
    """Documents with null and repeated ids, null columns, and names that operators use themselves."""
    texts = awkward_texts() if texts is None else texts
    rows = [
        (i, t, ["en", None, "fr"][i % 3], ["src1", "src2", None][i % 3], None if t is None else len(t), "k", "i", "t")
        for i, t in enumerate(texts)
    ]
    if len(rows) > 4:
        rows += [rows[3], rows[3], (None, texts[3], "en", "src1", 5, "k", "i", "t"), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)
