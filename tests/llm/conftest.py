import random

import pytest

#: Names that the operators use inside; as extra columns they must not matter.
CLASHES = ["row", "spans", "rest", "key", "bucket", "tail", "sig", "pivot", "words", "lines", "marks", "score", "kept", "at"]


def texts(seed: int = 3) -> list[tuple]:
    """(doc_id, text): near and exact copies, shared passages, ties, odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    out = []
    for i in range(40):
        own = [word() for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            own[10:10] = passage[rng.randint(0, 10):]
        out.append((i * 7, " ".join(own)))
        if i % 4 == 0:  # copies with some words changed
            for k in range(3):
                copy = list(own)
                for _ in range(rng.randint(0, 4)):
                    copy[rng.randrange(len(copy))] = word()
                out.append((i * 7 + 1 + k, ("\n" if k else " ").join(copy)))
    out += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "one"), (905, "One two"), (906, "Ünï cödé 🙂 日本語")]
    out += [(907, "a b c " * 400), (908, "x" * 5000), (909, "the same words again " * 30), (-5, out[0][1]), (910, out[3][1].upper())]
    out += [(0, out[0][1]), (911, " ".join(word() for _ in range(20000)))]  # a repeated row, a very long text
    return out


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(d, t, "en", "s", len(t or "")) + tuple(range(len(CLASHES))) for d, t in [*texts(), (None, "no id here " * 9)]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{c} long" for c in CLASHES)).repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
