"""Byte pairs, spelling variants and alignment against libraries, plain versions and SQL."""

import binascii
import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from stridelake.llm import alignment, bytepairs, queries, spelling

SF = "/root/testdata/sf0.001"
MULTI, BYTES, PIECES = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b\n \n c", "don't  DON'T", "<|endoftext|> <s></s> <unk> <0x41>", "▁x y", "x▁",
    "naïve Ünï 東京 🙂🙂 ‍", "aaaa" * 3000, "ab" * 5000, " " * 3000, "1234567890 " * 50, "é \x00\x1c\x85 　.", "\tif (x):\r\n\t\treturn\r\n",
    "end \n", "end\n ", "a\n  b", "﻿x", "ﬁ ½ Ⅳ",
]



@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytepairs.read_ranks(MULTI), special_tokens={})


def test_byte_pairs_are_the_librarys(documents, encoding):
    coder = bytepairs.byte_pairs(MULTI, P.PATTERN)
    for text in [t or "" for _, t, *_ in documents] + [t or "" for t in ODD]:
        ids = coder.encode(text)
        assert list(ids) == encoding.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_byte_pairs_of_random_bytes(encoding):
    coder = bytepairs.byte_pairs(MULTI, P.PATTERN)
    rng = random.Random(5)
    tokens = list(coder.ranks)
    for _ in range(4000):
        joined = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6)))
        for piece in (joined[: rng.randint(1, 60)], bytes(rng.choice(b"ab e") for _ in range(rng.randint(1, 40)))):
            assert list(coder.merged(piece)) == encoding._encode_single_piece(piece)


def test_tokens_that_no_merge_reaches(encoding):
    """Such a token is taken for a whole piece only, or never."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abcd": 257, b"ab": 258}
    coder = bytepairs.BytePairs(ranks, ".+")
    other = tiktoken.Encoding("small", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "xabcd", "abab", "abc", "ababcd"):
        assert list(coder.encode(text)) == other.encode_ordinary(text)
    assert list(bytepairs.BytePairs(ranks, ".+", whole_pieces=False).encode("abcd")) == [97, 256, 100]
    with pytest.raises(ValueError):
        bytepairs.BytePairs({b"a": 0}, ".+")


def test_encoded_documents(spark, make_docs, encoding):
    docs = make_docs([*enumerate(ODD), (1, "twice"), (1, "twice"), (None, "no id")])
    coded = bytepairs.decode_documents(bytepairs.encode_documents(docs, MULTI, P.PATTERN), MULTI, P.PATTERN)
    rows = coded.collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        assert r.n_tokens == len(r.packed_ids) // 4
        if r.doc_id is not None and r.doc_id > 1:
            text = ODD[r.doc_id] or ""
            assert np.frombuffer(r.packed_ids, "<u4").tolist() == encoding.encode_ordinary(text)
            assert bytes(r.decoded) == text.encode()
    assert bytepairs.encode_documents(docs.limit(0), MULTI, P.PATTERN).count() == 0


def test_op11_rows(spark, documents, encoding):
    rows = {r.doc_id: r for r in queries.op11_byte_bpe(spark, SF).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, *_ in documents:
        ids = np.array(encoding.encode_ordinary(text or ""), "<u4")
        expected = (doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert tuple(rows[doc_id]) == expected


def plain_variants(rows, every=199, min_length=6, min_count=5, ratio=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = binascii.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        n_near[w] = len(found)
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, n_near[w], words.get(form[w])))
    return out


WORDS = (
    "letter " * 160 + "lettar " * 30 + "lettaé " * 6 + "lettré " * 5 + "etters " * 5 + "letters " * 150 + "lettre " * 30
    + "élèvement " * 40 + "elèvement " * 8 + "élèvemen " * 7 + "ELEVEMENT " * 7 + "banana bananas bananb anabna ananab " * 9 + "aaaaaa aaaaaaa aaaaab baaaaa " * 6
    + "x" * 5000 + " "
)


@pytest.mark.parametrize("every", [None, 199, 3])
def test_variants_of_planted_words(spark, make_docs, every):
    long = ("y" * 4000 + " ") * 30 + ("y" * 4001 + " ") * 6 + ("y" * 2000 + "z" + "y" * 1999 + " ") * 6
    rows = [(1, WORDS), (2, long), (3, None), (4, ""), (None, WORDS), (1, "letter lettre"), (1, "letter lettre"), (5, "×÷×÷×÷ " * 9)]
    df = spelling.spelling_variants(make_docs(rows), typo_every=every)
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_variants(rows, every)


def test_variants_follow_chains(spark, make_docs):
    rows = [(1, "abcdef " * 3000 + "abcdeg " * 600 + "abcdhg " * 120 + "abcihg " * 24 + "ajcihg " * 4 + "kbcdef kbcdef kbcdef kbcdef kbcdef")]
    got = {r.word: r.root for r in spelling.spelling_variants(make_docs(rows), min_count=4).collect()}
    assert set(got.values()) == {"abcdef"} and len(got) == 6


def test_variants_of_nothing(spark, make_docs):
    for rows in ([], [(1, None)], [(1, "short")]):
        assert spelling.spelling_variants(make_docs(rows)).collect() == []


def test_op12_is_its_sql_and_a_plain_version(spark, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    got = {tuple(r[c] for c in names) for r in queries.op12_spelling(spark, SF).collect()}
    assert set(con.execute(f"SELECT {', '.join(names)} FROM ({queries.OP12_SQL})").fetchall()) == got
    assert plain_variants([d[:2] for d in documents]) == got


def plain_alignment(rows):
    """Straight from the rules, text by text, with the tokenizers library."""
    a_coder = Tokenizer.from_file(BYTES)
    a_coder.encode_special_tokens = True
    pair = alignment.tokenizer_pair(BYTES, PIECES, P.PATTERN)
    letters = {letter: b for b, letter in enumerate(bytepairs.byte_letters())}
    parts = []
    holds = defaultdict(set)
    for row, (_, text) in enumerate(rows):
        whole = b"" if not text else (" " + text).encode()
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_coder.id_to_token(i)) for i in a]
        b_bytes = [pair.b_bytes[i] for i in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            parts.append(None)
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        a_from, b_from = [0, *a_ends[:-1]], [0, *b_ends[:-1]]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            k, m = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links += [(a[x], b[y]) for x in range(i, k) for y in range(j, m) if a_from[x] < b_ends[y] and b_from[y] < a_ends[x]]
            i, j = k, m
        for link in links:
            holds[link].add(row)
        parts.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (a, _), held in holds.items():
        most[a] = max(most[a], len(held))
    out = []
    for (doc_id, _), part in zip(rows, parts, strict=True):
        if part is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = part
        counts = [len(holds[x]) for x in links]
        best = sum(c == most[x[0]] for c, x in zip(counts, links, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts), digest))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("slice_bytes", [alignment.SLICE_BYTES, 500])
def test_alignment_of_odd_texts(spark, make_docs, slice_bytes):
    short = [t if t is None or len(t) < 4000 else t[:700] for t in ODD]
    rows = [*enumerate(short), (1, "twice"), (1, "twice"), (None, "no id"), (77, "supercalifragilistic " * 9), (78, "ÄÖÜ😀" * 40)]
    df = alignment.align_tokens(make_docs(rows), BYTES, PIECES, P.PATTERN, slice_bytes=slice_bytes)
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_alignment(rows)))


def test_alignment_of_a_very_long_word(spark, make_docs):
    rows = [(1, "ab" * 200000), (2, "a" * 100001)]
    got = {r.doc_id: r for r in alignment.align_tokens(make_docs(rows), BYTES, PIECES, P.PATTERN).collect()}
    assert got[1].n_links >= got[1].n_groups > 0 and got[2].n_a > 0


def test_op13_rows(spark, documents):
    got = [tuple(r[c] for c in COLUMNS) for r in queries.op13_alignment(spark, SF).collect()]
    assert sorted(got) == sorted(plain_alignment([d[:2] for d in documents]))


def test_alignment_of_nothing(spark, make_docs):
    assert alignment.align_tokens(make_docs([]), BYTES, PIECES, P.PATTERN).collect() == []


def test_every_letter_is_cut_alike():
    """White space, letters and numbers are the same sets for all libraries."""
    pair = alignment.tokenizer_pair(BYTES, PIECES, P.PATTERN)
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    for low in range(0, 0x110000, 0x400):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  " for c in range(low, low + 0x400) if not 0xD800 <= c < 0xE000)
        if text:
            assert pair.a.encode_ordinary(text) == library.encode(text, add_special_tokens=False).ids
