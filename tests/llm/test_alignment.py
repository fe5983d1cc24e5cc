"""Alignments of whole texts by both libraries against those composed of segments."""

import hashlib
import json
import re
from collections import Counter

import numpy as np
import pytest

from greensward.llm import alignment, blocks
from greensward.llm.token_counts import default_model
from greensward.llm.token_ids import default_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(default_tokenizer(), default_model())


def whole(aligner, text):
    """Groups of a whole text as lists of id lists, tokenized in one call."""
    if not text:
        return []
    raw = f" {text}".encode()
    a = aligner.a.encode(f" {text}", add_special_tokens=False).ids
    b = aligner.b.encode(text)
    ends = lambda ids, table: np.cumsum([len(table[i]) for i in ids]).tolist()
    if b"".join(aligner.a_bytes[i] for i in a) != raw or b"".join(aligner.b_bytes[i] for i in b) != raw:
        return []
    ea, eb = ends(a, aligner.a_bytes), ends(b, aligner.b_bytes)
    out, start = [], 0
    for end in sorted(set(ea) & set(eb)):
        out.append(([i for i, e in zip(a, ea, strict=True) if start < e <= end], [i for i, e in zip(b, eb, strict=True) if start < e <= end]))
        start = end
    return out


def brute(aligner, rows):
    groups = [whole(aligner, t) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for c in links for p in c)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), g, c in zip(rows, groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        n_best = sum(t for p, t in c.items() if count[p] == best[p[0]])
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), n_best, sum(t * count[p] for p, t in c.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


EDGES = ["", " ", "   ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "tab\tx y", "x\xa0 y", "x \xa0y z", "a\x1c b", "mark▁ in it", "one ▁two", "<s> </s> <|endoftext|> <0x41>", "é ü ß — …", "漢字 かな 한국어", "😀 😀😀", "\x00 nul", "don't we'll", "x" * 3000, "ab " * 2000, "12345 678 9", "a   b    c", "\r\nline \r\n", "'s 's", "　wide　 space", "é combining"]


def test_cut_texts_tokenize_like_whole_ones(aligner):
    assert aligner.cuts
    rng = np.random.default_rng(3)
    alphabet = list("ab,.'1 \n\t\r") + ["  ", " \n", "é", "\xa0", "\x85", "\x1c", " ", "漢", "▁", "'s", "the", " the", "<s>"]
    texts = EDGES + ["".join(rng.choice(alphabet, rng.integers(1, 40))) for _ in range(3000)]
    for t in texts:
        parts = aligner.groups(aligner.segments(t))
        want = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in whole(aligner, t))
        assert ("" if None in parts else ";".join(parts)) == want, repr(t)


def test_a_file_that_merges_over_cuts_is_not_cut(aligner, tmp_path):
    with open(default_tokenizer(), encoding="utf-8") as f:
        kind = json.load(f)
    kind["pre_tokenizer"]["use_regex"] = False
    path = tmp_path / "other.json"
    path.write_text(json.dumps(kind))
    other = alignment.Aligner(str(path), default_model())
    assert not other.cuts and other.segments("a b") == [" a b"]


def test_links_of_segments():
    links = alignment.Links(["1,2|7;3|8,8", None, "1|7", ""])
    assert links.good.tolist() == [True, False, True, True]
    assert (links.n_a.tolist(), links.n_b.tolist(), links.n_groups.tolist()) == ([3, 0, 1, 0], [3, 0, 1, 0], [2, 0, 1, 0])
    doc, pair, times = links.of_documents(np.array([0, 2, 2]), np.array([0, 0, 1]))
    names = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in links.pairs]
    assert sorted((int(d), *names[p], int(t)) for d, p, t in zip(doc, pair, times, strict=True)) == [(0, 1, 7, 2), (0, 2, 7, 1), (0, 3, 8, 2), (1, 1, 7, 1)]


@pytest.mark.parametrize("small", [False, True])
def test_the_table(spark, aligner, monkeypatch, small):
    if small:
        monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
        monkeypatch.setattr(blocks, "SLICE_BYTES", 3000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in alignment.align_documents(docs).collect()), key=str)
    assert got == brute(aligner, [tuple(r) for r in docs.collect()])


def test_edges(spark, aligner, monkeypatch):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(3, "a"), (None, "a b"), (500, None)]
    docs = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id bigint, text string, block string, n int")
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 50)
    got = sorted((tuple(r) for r in alignment.align_documents(docs).collect()), key=str)
    assert got == brute(aligner, rows)
    assert alignment.align_documents(docs.where("false")).count() == 0
    only = alignment.align_documents(docs.where("text is null or text = ''")).collect()
    assert [tuple(r)[1:] for r in only] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert re.fullmatch("[0-9a-f]{64}", next(r.groups_sha256 for r in alignment.align_documents(docs).collect() if r.doc_id == 4))
