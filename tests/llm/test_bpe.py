import hashlib
import random
from unicodedata import category

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordwash.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def same(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    mine = np.frombuffer(own.encode(text), "<i4").tolist()
    return ids == mine and own.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(library, own):
    draw = random.Random(5)
    parts = [*"abcdeé ΣΑΒ'sStT1２²İß\n\t!?　\x1c", "<|endoftext|>", "<|startoftext|>", "'ll"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 60)))
        assert same(library, own, text), text


def test_every_code_point(library, own):
    points = [c for c in range(0x30000) if category(chr(c)) not in ("Cn", "Cs")]
    for at in range(0, len(points), 64):
        text = " ".join(f"a{chr(c)}b1 {chr(c)}{chr(c)}!" for c in points[at : at + 64])
        assert same(library, own, text), hex(points[at])


def test_unassigned_code_points_too(library, own):
    points = [c for c in range(0x110000) if category(chr(c)) != "Cs"]
    for at in range(0, len(points), 512):
        text = " ".join(f"a{chr(c)}1" for c in points[at : at + 512])
        assert same(library, own, text), hex(points[at])
    for c in (0x558, 0x88F, 0x1C89, 0x1ACF, 0x10D40, 0xE01F5):
        for text in (f"A{chr(c)}\u0301B", f"<|endoftext|>{chr(c)} Σ{chr(c)}", f"{chr(c)}{chr(c)}'s 12"):
            assert same(library, own, text), hex(c)


def test_long_words(library, own):
    for text in ("x" * 30_000, "ab" * 20_000, cases.sentence(4, 4000).replace(" ", "")):
        assert same(library, own, text)


def test_tree_yields_leftmost_lowest():
    draw = random.Random(6)
    for n in (1, 2, 3, 7, 8, 9, 33):
        ranks = [draw.randint(0, 5) for _ in range(n)]
        tree = bpe.PairTree(ranks)
        for _ in range(50):
            root = tree.low[1]
            assert root >> bpe.PLACE_BITS == min(ranks)
            assert root & (1 << bpe.PLACE_BITS) - 1 == ranks.index(min(ranks))
            place = draw.randrange(n)
            ranks[place] = draw.choice([draw.randint(0, 5), bpe.NO_RANK])
            tree.put(place, ranks[place])
            if min(ranks) == bpe.NO_RANK:
                assert tree.low[1] >= bpe.NEVER
                ranks[0] = 1
                tree.put(0, 1)


def test_query_rows(spark, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = queries.encoded_digests(cases.frame(spark)).collect()
    want = []
    for i, text in cases.texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(decoded)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_columns_stay_and_names_give_way(spark):
    docs = cases.frame(spark)
    coded = bpe.encode(docs, PATH)
    assert coded.columns == [*docs.columns, "_token_ids"]
    back = bpe.decode(coded, PATH, "_token_ids")
    both = bpe.round_trip(docs, PATH)
    assert back.columns[-1] == both.columns[-1] == "_decoded"
    text = lambda df: sorted((r["doc_id"] or 0, r["_decoded"]) for r in df.collect())
    assert text(back) == text(both)
    assert bpe.round_trip(cases.empty(spark), PATH).count() == 0
