import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recordwash.llm import align
from recordwash.llm.bpe import byte_letters
from recordwash.llm.queries import BYTE_BPE, PIECE_BPE, op11_align

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def sides():
    with open(BYTE_BPE) as a, open(PIECE_BPE, "rb") as b:
        return align.Sides(a.read(), b.read())


def tokens(text):
    """(id, first byte, end) of both sides, by the libraries alone; none if the bytes differ."""
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    letters = {c: i for i, c in enumerate(byte_letters())}
    if not text:
        return [], []
    of_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
        for i in b.encode(text)
    ]
    out = []
    for side in (of_a, of_b):
        if b"".join(x[1] for x in side) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(x[1]) for x in side]).tolist()
        out.append([(x[0], end - len(x[1]), end) for x, end in zip(side, ends)])
    return out


def expected(rows):
    found, held = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text)
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low = [], 0
        for cut in cuts:
            of = [",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(of))
            low = cut
        links = Counter()
        for i, s, e in a:
            links.update((i, j) for j, s2, e2 in b if s < e2 and s2 < e)
        held.update(links.keys())
        found.append((doc_id, len(a), len(b), groups, links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [
        (doc_id, n_a, n_b, len(groups), links.total(),
         sum(n for p, n in links.items() if held[p] == most[p[0]]),
         sum(n * held[p] for p, n in links.items()), ";".join(groups))
        for doc_id, n_a, n_b, groups, links in found
    ]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def awkward():
    rows = [(i, t if t is None else t[:1500]) for i, t in cases.texts()]
    rows += [(30, "a▁b"), (31, " lead"), (32, "two  spaces   three\n\nlines\t end "), (33, " "),
             (34, "emoji 👩‍👩‍👧 👍🏽 x"), (35, "é́ é ﬁ ½"), (36, "it's I'll <|endoftext|> <s> </s> <unk>"),
             (37, "\x00 \x01 \x1c a"), (38, "日本語 の テキスト 한국어"), (39, "0x41 <0x41> 1234567")]
    return rows


@pytest.mark.parametrize("block", [align.BLOCK_BYTES, 200])
def test_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(align, "BLOCK_BYTES", block)
    monkeypatch.setattr(align, "SLICE_BYTES", 100)
    monkeypatch.setattr(align, "SENT_PAIRS", 7)
    found = align.align(cases.frame(spark, awkward()), BYTE_BPE, PIECE_BPE)
    assert found.columns == [*COLUMNS[:5], "groups", *COLUMNS[5:7]]
    assert in_order(map(tuple, found.select(COLUMNS).collect())) == in_order(expected(awkward()))


def test_empty_table(spark):
    assert align.align(cases.empty(spark), BYTE_BPE, PIECE_BPE).collect() == []


def test_pieces_give_the_ids_of_the_whole(sides):
    draw = random.Random(4)
    signs = [" ", "  ", "a", "the", "'s", "'", "\n", "\t", "　", "\xa0", "\x1c", "é", "é", "▁",
             "1", ".", "<|endoftext|>", "日", "​", "᠎", "﻿", "👍", "́"]
    texts = [" " + "".join(draw.choices(signs, k=draw.randint(1, 12))) for _ in range(5000)]
    assert sides.ids(texts) == sides.encode(texts)


def test_any_sign_beside_a_cut(sides):
    draw = random.Random(5)
    signs = [chr(c) for c in [*range(0x3100), *draw.sample(range(0x3100, 0x30000), 3000)] if not 0xD800 <= c < 0xE000]
    texts = [f" a {c} {c}b{c} {c}{c} c" for c in signs]
    assert sides.ids(texts) == sides.encode(texts)


def test_groups_break_where_a_start_reaches_the_ends():
    group_a, group_b = align.groups_of(*map(np.array, ([0, 2, 5], [2, 5, 9], [0, 3, 5, 7], [3, 5, 7, 9])))
    assert group_a.tolist() == [0, 0, 1] and group_b.tolist() == [0, 0, 1, 1]


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = op11_align(spark, sf_dir).select(*COLUMNS[:7], "groups_sha256").collect()
    assert len(found) == len(rows)
    short = {r[0]: r for r in expected([tuple(r) for r in rows if len(r["text"] or "") < 3000])}
    for row in found:
        if row[0] in short:
            want = short[row[0]]
            digest = hashlib.sha256(want[7].encode()).hexdigest() if want[1] else ""
            assert (*row[:5], row[7]) == (*want[:5], digest)
