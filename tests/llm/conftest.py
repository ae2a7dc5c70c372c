import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, n_tokens long, shard int"


def awkward_texts():
    rng = random.Random(5)
    words = [("".join(rng.choice("aeiourstnldéñß") for _ in range(rng.randint(1, 9)))) for _ in range(300)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    return [
        None, "", " \n\t ", "a", "<|endoftext|> and <|startoftext|>", "ΑΣ ½ ² x\x1cy z", "It's I'LL\n\n\ntail  ",
        "é \U0001f600 中文", prose[0], prose[0], prose[0] + " more", *prose, "long " * 30000, "x" * 5000,
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """Texts of all kinds: null, empty, long, repeated; null and repeated ids; columns named like results."""
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, "x", 7, 3) for i, t in enumerate(awkward_texts())]
    rows += [(None, "no id", None, None, None, None, None, None, None), rows[9], rows[9]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]
