"""Alignment, piece encoding and collocations against plain versions, and on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from notevalue.llm import alignment, collocations, queries, sentence_pieces, token_counts, toxicity
from notevalue.session import cut

LONG = "Word after word, and another. " * 4000
TEXTS = [
    None, "", " ", "  \n\t ", "one", "Same words here again, and again", "Same words here again, and again", "x▁y and ▁", "日本語の長い文" * 300,
    "ÄÖÜ ß 😀 \x00 naïve\x0bcafé\x1cx  two", "<s> <0x41> <|endoftext|> ＡＢ ﻿12345", LONG, "y" * 3000,
]


@pytest.fixture(scope="session")
def strange(spark):
    schema = "doc_id bigint, text string, lang string, ids string, links string, n_a string, part string, cell string, n string"
    rows = [(i if i != 4 else None, t, [None, "en", "und"][i % 3], "a", "b", "c", "d", "e", "f") for i, t in enumerate(TEXTS)]
    return cut(spark.createDataFrame([*rows, rows[5]], schema))


@pytest.fixture(scope="session")
def texts(spark, small):
    return {r["doc_id"]: r["text"] for r in queries.table(spark, small, "documents").select("doc_id", "text").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@cache
def sides():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_alignment(docs):
    """{doc_id: (n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum)} from sets of common ends."""
    first, second = sides()
    a_side, b_side = alignment.spaced_byte_bpe_50k(), alignment.piece_bpe_32k()
    found, counts = {}, Counter()
    for doc, text in docs.items():
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        if any(b"".join(side.surface[i] for i in ids) != b" " + (text or "").encode() for side, ids in ((a_side, a), (b_side, b))):
            a, b = [], []
        ends = [{int(e): k for k, e in enumerate(np.cumsum([len(side.surface[i]) for i in ids]))} if ids else {} for side, ids in ((a_side, a), (b_side, b))]
        rows, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0][end] + 1, ends[1][end] + 1
            rows.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            links.append((a[i2 - 1], b[j2 - 1]))
            i, j = i2, j2
        counts.update(links)
        found[doc] = len(a), len(b), rows, links
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return {
        doc: (n_a, n_b, len(rows), sha(";".join(rows)) if n_a else "", len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links))
        for doc, (n_a, n_b, rows, links) in found.items()
    }


def test_alignment_matches_common_ends(spark, small, texts, strange, monkeypatch):
    got = {r[0]: tuple(r)[1:] for r in queries.op11_alignment(spark, small).select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum").collect()}
    assert got == plain_alignment(texts)
    monkeypatch.setattr(alignment, "BLOCK", 3)
    rows = alignment.linked(cut(alignment.align(strange))).select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum").collect()
    expected = plain_alignment({i: t for i, t in enumerate([*TEXTS, TEXTS[5]])})
    assert sorted(tuple(r)[1:] for r in rows) == sorted(expected.values())
    assert [r["n_a"] for r in rows if r["doc_id"] in (0, 1, 7)] == [0, 0, 0]
    assert alignment.linked(cut(alignment.align(strange.limit(0)))).count() == 0


def test_runs_are_found_wherever_ends_agree():
    rng = random.Random(6)
    for _ in range(300):
        size = rng.randrange(1, 60)
        ends = [sorted({size, *rng.sample(range(1, size + 1), rng.randrange(size))}) for _ in range(2)]
        found = []
        for in_step, i, j, i2, j2 in alignment.groups(np.array(ends[0]), np.array(ends[1])):
            found += [(i + k + 1, j + k + 1) for k in range(i2 - i)] if in_step else [(i2, j2)]
        common = sorted(set(ends[0]) & set(ends[1]))
        assert found == [(ends[0].index(e) + 1, ends[1].index(e) + 1) for e in common]


def test_groups_are_hashed_from_arrays_whatever_the_block(monkeypatch):
    """Before, the names of every group were put together one by one, and a group of any length at once."""
    rng = random.Random(8)
    sides_ = [alignment.Tokenizer(None, [b"x" * n for n in range(1, 30)]) for _ in range(2)]
    aligner = alignment.Aligner(*sides_)
    for block in (1, 2, 3, 1 << 16):
        monkeypatch.setattr(alignment, "BLOCK", block)
        for _ in range(50):
            size = rng.randrange(1, 28)
            ends = [sorted({size, *rng.sample(range(1, size + 1), rng.randrange(size))}) for _ in range(2)]
            a, b = (np.diff(e, prepend=0) - 1 for e in ends)
            common = sorted(set(ends[0]) & set(ends[1]))
            last = [np.array([e.index(c) for c in common]) for e in ends]
            cuts = [np.split(ids, at[:-1] + 1) for ids, at in zip((a, b), last, strict=True)]
            plain = ";".join("|".join(",".join(map(str, side)) for side in pair) for pair in zip(*cuts, strict=True))
            assert aligner._digest(a, b, *last) == sha(plain)


def test_possible_links_bound_all_linked_pairs():
    sides_ = [alignment.Tokenizer(None, x) for x in ([b"a", b"ba", b"c"], [b"a", b"a", b"ba", b"xc"])]
    pairs = [(a, b) for a in sides_[0].surface for b in sides_[1].surface if a.endswith(b) or b.endswith(a)]
    assert alignment.possible_links(*sides_) == len(pairs)


def test_pieces_match_the_library(spark, small, texts, strange):
    library = sides()[1]
    for r in queries.op12_sentence_pieces(spark, small).collect():
        ids = library.encode(texts[r["doc_id"]] or "")
        assert tuple(r)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    rows = sentence_pieces.decode(sentence_pieces.encode(strange, whole=True)).collect()
    assert sorted(tuple(r["ids"]) for r in rows) == sorted(tuple(library.encode(t or "")) for t in [*TEXTS, TEXTS[5]])
    assert all(r["text"] == library.decode(r["ids"]) for r in rows)
    assert sentence_pieces.decode(sentence_pieces.encode(strange.limit(0))).count() == 0


def test_agendas_and_decoding_match_the_library_on_noise(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "LONGEST", 9)
    pieces, rng = sentence_pieces.Pieces(sentence_pieces.piece_bpe_32k()), random.Random(7)
    noise = ["".join(rng.choices("ab c  ▁\x00\n\té日本😀the12<>", k=rng.randrange(40))) for _ in range(2000)]
    assert list(pieces.encode(noise)) == [pieces.library.encode(t) for t in noise]
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32_000)]) for _ in range(rng.randrange(8))]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def plain_phrases(rows, least, top=2000):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, f in counts.items():
        candidates, longer = {k: a for k, a in f.items() if len(k) > 1 and a >= least}, defaultdict(int)
        for k, a in candidates.items():
            for size in range(2, len(k)):
                for i in range(len(k) - size + 1):
                    longer[k[i : i + size]] = max(longer[k[i : i + size]], a)
        ranked = []
        for k, a in candidates.items():
            if not (longer[k] and 100 * longer[k] >= 80 * a):
                score, at = min((2_000_000 * a // (f[k[:i]] + f[k[i:]]), i) for i in range(1, len(k)))
                ranked.append((-score, -a, " ".join(k).encode(), f[k[:at]], f[k[at:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def test_phrases_match_plain_counts(spark, small, strange):
    docs = queries.table(spark, small, "documents")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, queries.op13_collocations(spark, small).collect())) == plain_phrases(rows, 30)
    # Many shards and ranges, and a bitmap that is nearly full.
    options = {"least": 3, "shard_words": 500, "range_bytes": 10_000, "power": 10, "top": 40}
    assert sorted(map(tuple, collocations.mine(docs, **options).collect())) == plain_phrases(rows, 3, 40)
    odd = [(r["lang"], r["text"]) for r in strange.collect()]
    assert sorted(map(tuple, collocations.mine(strange, least=2).collect())) == plain_phrases(odd, 2)
    assert collocations.mine(strange.limit(0)).count() == 0


def test_transducers_share_states_and_add_up():
    keys = [((b"a", b"x"), 2), ((b"a", b"x", b"z"), 1), ((b"b", b"x"), 2), ((b"b", b"x", b"z"), 1), ((b"c",), 5)]
    one = collocations.from_keys(keys)
    assert list(one.sequences()) == keys and len(one.first) - 1 == 4
    other = collocations.from_keys([((b"b", b"x"), 3), ((b"d",), 1)])
    assert list(collocations.union([one, other], 3)) == [((b"b", b"x"), 5), ((b"c",), 5)]
    asked = collocations.from_keys([((b"a", b"x", b"z"), 1), ((b"b",), 1), ((b"c",), 1)])
    assert list(collocations.compose(asked, one)) == [((b"a", b"x", b"z"), 1), ((b"c",), 5)]


def test_whole_words_and_unspaced_scripts_are_tokens():
    assert toxicity.tokens(("L" * 60 + " don’t Ünder").encode()) == [b"l" * 60, "don’t".encode(), "Ünder".encode()]
    assert toxicity.tokens("这是 x中".encode()) == ["这".encode(), "是".encode(), b"x", "中".encode()]


def test_totals_leave_unfinished_batches_out(spark, tmp_path):
    counted = token_counts.count_texts(spark.createDataFrame([(1, "a b", "s", "en")], "doc_id int, text string, source string, lang string"), {"w/1": token_counts.space_words})
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    ledger.commit("a", token_counts.inserts(counted))
    ledger.commit("b", token_counts.inserts(counted))
    (tmp_path / "ledger" / "batch-b" / "_SUCCESS").unlink()
    assert not ledger.committed("b") and [(r["docs"], r["tokens"]) for r in ledger.totals().collect()] == [(1, 2)]
    (tmp_path / "empty").mkdir()
    assert token_counts.Ledger(spark, str(tmp_path / "empty")).totals().count() == 0


def test_a_decoder_holds_no_merge_tables_and_slices_its_batches(spark, monkeypatch):
    pieces = sentence_pieces.Pieces(sentence_pieces.piece_bpe_32k(), encodes=False)
    assert not hasattr(pieces, "pairs") and pieces.decode(pieces.library.encode("a plain text")) == "a plain text"
    kept = sentence_pieces.Pieces(sentence_pieces.piece_bpe_32k())
    kept.learn(["▁hello", "▁hello."])
    assert all(x is kept.numbers[x] for ids in kept.values() for x in ids)
