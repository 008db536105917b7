import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, rows__ string"
WORDS = "the of and a to in is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out".split()


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(("", "", "s", "ing", "ed")) for _ in range(n)).capitalize() + "."


def prose(seed, sentences):
    rnd = random.Random(seed)
    return "\n".join(" ".join(sentence(rnd, rnd.randrange(6, 14)) for _ in range(4)) for _ in range(sentences // 4 + 1))


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, ties, repeated rows, groups of copies and near copies, odd characters."""
    rnd = random.Random(7)
    texts = [prose(k, 4 + k % 17) for k in range(60)]
    texts += [texts[3]] * 25  # one hot group of copies
    for k in range(25):  # near copies of one text, some nearer than others
        words = texts[5].split(" ")
        for _ in range(k % 9 + 1):
            words[rnd.randrange(len(words))] = f"edit{k}x{rnd.randrange(99)}"
        texts.append(" ".join(words))
    texts += ["", " \n\t ", "one", "one two three four", "ONE two THREE four", "one two three four five", "Ärger über Öl, été à côté. 日本語 😀 ☃", "a b c \x1c d", "<|endoftext|> and <s> are text", prose(99, 900), "\x0b\x0c\r\n", "x" * 3000]
    out = [(k, t, "en", f"src{k % 4}" if k % 3 else "src0", len(t), "clash", "clash") for k, t in enumerate(texts)]
    out += [(1000, None, None, None, None, None, None), (1001, None, "en", None, 0, None, None), (None, prose(500, 6), "en", "src1", 1, None, None), (None, prose(501, 6), "en", "é", 1, None, None), (-5, prose(502, 8), "en", "src1", 1, None, None)]
    out += [out[2], out[2]]  # repeated rows
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def unique(spark, rows):
    """Without repeated rows and null ids, for brute force by id."""
    own = {r[0]: r for r in rows if r[0] is not None}
    return spark.createDataFrame(list(own.values()), SCHEMA).repartition(5).cache(), {k: r[1] or "" for k, r in own.items()}


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
