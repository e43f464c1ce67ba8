"""What a worker remembers of a tokenizer's units is bounded in bytes, and never changes a result."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfline.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(units, texts):
    return [memoryview(x).cast("I").tolist() for x in units.encode(pa.array(texts, pa.large_string()))]


@pytest.mark.parametrize("memory", [0, 30_000, tokens.MEMORY])
def test_same_ids_whatever_is_remembered(memory):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcé日.,") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    texts = [rng.choice(["", " "]) + " ".join(rng.choice(vocabulary) for _ in range(50)) for _ in range(60)]
    units, tokenizer = tokens.Units(open(PATH, encoding="utf-8").read(), memory), Tokenizer.from_file(PATH)
    for a in range(0, 60, 7):
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[a : a + 7]]
        assert ids_of(units, texts[a : a + 7]) == want
        assert tokens.weight(units.young) + tokens.weight(units.old) <= memory


def test_long_units_are_not_remembered():
    units = tokens.Units(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    for _ in range(10):
        texts = [" ".join(rng.randbytes(64).hex() for _ in range(100)) for _ in range(100)]  # 100,000 units of 128
        list(units.encode(pa.array(texts, pa.large_string())))
        assert tokens.weight(units.young) + tokens.weight(units.old) < 10_000


def test_many_short_units_keep_to_the_bound():
    units = tokens.Units(open(PATH, encoding="utf-8").read(), 4 << 20)
    for a in range(0, 100_000, 5000):
        list(units.encode(pa.array([" ".join(map(str, range(a, a + 5000))) + " the"], pa.large_string())))
        assert units.used >= tokens.weight(units.young) and tokens.weight(units.young) + tokens.weight(units.old) <= 4 << 20
    assert " the" in units.young or " the" in units.old
