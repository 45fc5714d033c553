import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, *columns):
    """Collected rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with nulls, empty, short and very long texts, copies, near copies, repeats and equal doc_ids."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = [prose(rng.randint(60, 200)) for _ in range(25)]
    passage = prose(60)
    texts = list(base)
    for t in base[:8]:
        words = t.split()
        words[len(words) // 2] = "changed"
        texts += [t, " ".join(words), " ".join(words[:-1])]
    texts += [prose(50) + " " + passage + " " + prose(40) for _ in range(6)]
    texts += ["", " ", "\n\n", "one", "One two", "a  b\t c", "x" * 3000, prose(6000), "ab " * 400, "line one\n" * 60]
    texts += ["日本語 🙂 é \x00 <s> ▁▁ x", "UPPER case WORDS here", "upper CASE words here"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(3, "another text under a used number " + prose(30), "en", "s", 1), rows[4], rows[4]]
    rows += [(None, base[0], None, None, None), (None, prose(70), "fr", "s", 2), (900, None, "en", None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
