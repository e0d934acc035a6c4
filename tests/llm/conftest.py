import random

import pytest
from public_tokenizers import path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, copy string, kept string, score string"


@pytest.fixture(scope="session")
def vocabulary():
    with open(path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="session")
def table(spark):
    """Makes documents of texts; ids count from 0; extra columns have names that results have too."""

    def make(texts, sources=None):
        rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], None if t is None else len(t), "x", None, "y") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, blanks, repeats, ties, very long words and texts, and signs that tokenizers treat apart."""
    rng = random.Random(7)
    words = ["the", "Of", "and", "ΣΣ", "İx", "naïve", "don't", "x1y2", "<|endoftext|>", "…", "中文", "😀", "#$%", "a" * 300]
    long = " ".join(rng.choice(words) for _ in range(6000))
    some = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    return [None, "", "  \n\t", "a", "a", "A a", long, long, long + " end", "z" * 20000, *some, *some[:10], "tab\tand\x1cfs\x85nel ls", "\x01 \x01"]


def brute_sets(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_components(texts):
    sets, top = [brute_sets(t) for t in texts], list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]
