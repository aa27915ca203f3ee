import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stridelake.llm import bpe, forest, language, licences, packing, pages, quality, shards, subwords, tokens
from stridelake.llm.minhash import fast_similarity_sketch, near_duplicates

path = lambda name: str(public_tokenizers.path(name))
ODD = [
    "", "  ", None, "it's 12 a1b2 I'll  don't", "É́x <|endoftext|> a<|startoftext|>b", "naïve ＡＢ　c\x1cq w", "x" * 300 + "é" * 200,
    "ǅ İstanbul ß ﬁ 日本語 ΑΣ", "\x00\x01 \x7f~", "１２3 ½ ²", "a ▁ b▁c", " lead  and trail ", "line\nbreaks\n\n\tend",
]


def test_word_ids_are_the_library_s(documents):
    tokenizer = tokens.word_tokenizer(path("word_bpe_49k.json"))
    texts = ODD + [t for _, t, *_ in documents]
    ids, counts = tokenizer.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        assert ids[end - n : end].tolist() == tokenizer.library.encode(text or "", add_special_tokens=False).ids


def test_long_words_merge_as_short_ones_do(monkeypatch):
    tokenizer = tokens.WordTokenizer(path("word_bpe_49k.json"))
    texts = ["abracadabra" * 5, "mississippi" * 4]
    short = tokenizer.encode(pa.array(texts))[0].tolist()
    monkeypatch.setattr(bpe, "LONG", 2)
    assert tokens.WordTokenizer(path("word_bpe_49k.json")).encode(pa.array(texts))[0].tolist() == short


def _plain_agenda(symbols, table, skipped):
    """One word, merged as the method says: at each step the lowest-ranked candidate that wasn't skipped when it came up."""
    symbols, places, step, skip = list(symbols), list(range(len(symbols))), 0, {}

    def look(i):
        pair = np.array([symbols[i]]), np.array([symbols[i + 1]])
        rank, merged = (int(x[0]) for x in table.find(*pair))
        drop = rank != bpe.NEVER and bool(skipped(np.zeros(1, np.uint64), *pair, np.array([places[i]]), step)[0])
        return (bpe.NEVER if drop else rank), merged

    agenda = [look(i) for i in range(len(symbols) - 1)]
    while agenda and min(agenda)[0] != bpe.NEVER:
        at = min(range(len(agenda)), key=lambda i: (agenda[i][0], i))
        step += 1
        symbols[at : at + 2] = [agenda[at][1]]
        del places[at + 1], agenda[at]
        for i in (at - 1, at):
            if 0 <= i < len(agenda):
                agenda[i] = look(i)
    return symbols


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_both_paths_of_dropout_equal_a_plain_agenda(monkeypatch, dropout):
    model = subwords.piece_model(path("piece_bpe_32k.model"))
    words = [subwords.MARK + w for w in ("international", "mississippi" * 3, "x", "abracadabra" * 12, "aaaaaaaaaaaa")]
    symbols = [np.array([model.letters[ord(c)] for c in w], np.int32) for w in words]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in symbols])])

    def skipped(key, left, right, place, step):
        return subwords.W.mix(key ^ subwords.candidate_hash(left, right, place, step)) < np.uint64(int(dropout * 2**63) * 2)

    with np.errstate(over="ignore"):
        expected = [_plain_agenda(x.tolist(), model.table, skipped) for x in symbols]
        for long in (2, 96, 1000):
            monkeypatch.setattr(bpe, "LONG", long)
            ids, edges = bpe.merge(np.concatenate(symbols), bounds, model.table, np.zeros(len(words), np.uint64), skipped)
            assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == expected


def test_dropout_tables_of_odd_texts(spark, make_docs):
    rows = [(1, "some words here, some words there"), (1, "some words here, some words there"), (2, None), (3, ""), (None, "no id"), (4, "long " * 40_000)]
    encoded = subwords.encode_with_dropout(make_docs(rows), path("piece_bpe_32k.model"))
    out = {r["doc_id"]: (r["n_ids"], len(r["ids"])) for r in encoded.collect()}
    assert encoded.count() == 6 and out[2] == out[3] == (0, 0) and all(a == b for a, b in out.values())
    texts = {(r["doc_id"], r["text"]) for r in subwords.decode_ids(encoded, path("piece_bpe_32k.model")).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    assert subwords.encode_with_dropout(make_docs([]), path("piece_bpe_32k.model")).collect() == []
    broken = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    back = subwords.decode_ids(subwords.encode_with_dropout(broken, path("piece_bpe_32k.model")), path("piece_bpe_32k.model"))
    assert back.first()["text"] == "a\ufffdb"


def test_merge_dropout_decodes_losslessly_and_varies(documents):
    model = subwords.piece_model(path("piece_bpe_32k.model"))
    texts = [t or "" for t in ODD] + [t for _, t, *_ in documents[:60]]
    keys = np.arange(len(texts))
    seen = []
    for dropout, seed in ((0.0, 1), (0.1, 1), (0.1, 1), (0.1, 2), (1.0, 1)):
        ids, counts = model.encode(pa.array(texts), keys, dropout, seed)
        ends = np.cumsum(counts)
        parts = [ids[e - n : e].tolist() for n, e in zip(counts, ends)]
        assert [model.decode(p) if p else "" for p in parts] == texts
        seen.append(parts)
    assert seen[1] == seen[2] and seen[1] != seen[3] and seen[0] != seen[1]
    assert all(p == model.library.encode(t) for p, t in zip(seen[0], texts) if "▁" not in t)


def test_merge_dropout_draws_every_occurrence_by_itself():
    model = subwords.piece_model(path("piece_bpe_32k.model"))
    ids, counts = model.encode(pa.array([" ".join(["international"] * 4000)] * 2), np.arange(2), 0.1, 1)
    assert counts[0] != counts[1]
    cuts = np.flatnonzero([model.pieces[i].startswith(subwords.MARK) for i in ids.tolist()])
    forms = {tuple(p.tolist()) for p in np.split(ids, cuts[1:])}
    assert len(forms) > 8
    # A word of one candidate merge is split in a tenth of its occurrences.
    whole = lambda p: model.library.encode(p[1]) == [model.library.piece_to_id(p)]
    pair = next(p for p in model.pieces if len(p) == 2 and p[0] == subwords.MARK and p[1].isascii() and whole(p))
    for seed in range(4):
        _, counts = model.encode(pa.array([" ".join([pair[1]] * 20000)]), np.zeros(1, np.int64), 0.1, seed)
        assert 0.09 < counts[0] / 20000 - 1 < 0.11


@pytest.mark.parametrize(("shape", "over"), [("uniform", 1.04), ("documents", 1.01)])
def test_sum_of_squares_places_every_piece(shape, over):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 3000) if shape == "uniform" else np.clip(rng.lognormal(2.3, 1, 3000).astype(int) + 1, 1, 100)
    sizes = sizes[packing.packing_order(sizes, np.arange(3000), np.zeros(3000, int), 100)]
    bins, offsets = packing.sum_of_squares(sizes, 100)
    held = {}
    for b, o, s in zip(bins.tolist(), offsets.tolist(), sizes.tolist()):
        assert held.get(b, 0) == o
        held[b] = o + s
    assert max(held.values()) <= 100 and len(held) <= over * sizes.sum() / 100 + 1


def test_packing_query_contract(make_docs):
    tokenizer = tokens.word_tokenizer(path("word_bpe_49k.json")).library
    rows = [(1, "word " * 5000), (2, None), (3, ""), (4, "short text"), (5, "short text")]
    out = packing.pack_documents(make_docs(rows), path("word_bpe_49k.json")).collect()
    expected = {}
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            expected[doc, k // 2048] = (k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == expected
    assert packing.pack_documents(make_docs([]), path("word_bpe_49k.json")).collect() == []


def test_capacity_tree_finds_the_least_that_suffices():
    rng = np.random.default_rng(2)
    tree, held = shards.CapacityTree(50), []
    for _ in range(600):
        size = int(rng.integers(1, 51))
        best = min([h for h in held if h >= size], default=-1)
        assert tree.smallest_from(size) == best
        if best >= 0 and rng.random() < 0.5:
            held.remove(best)
            tree.add(best, -1)
        else:
            held.append(size)
            tree.add(size, 1)


def test_shards_restore_all_ids(make_docs):
    rows = [(i, f"document {i} " * (1 + 37 * i)) for i in range(12)] + [(50, None), (51, "")]
    ranks, pattern = path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = shards.packed_shards(make_docs(rows), ranks, pattern, capacity=128).collect()
    encode = shards.rank_encoding(ranks, pattern).encode_ordinary
    parts = {}
    for r in out:
        ids, positions = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<u2")
        assert len(ids) == 128 and r["cu_seqlens"][-1] == r["n_ids"] <= 128
        for doc, piece, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            parts[doc, piece] = ids[a:b].tolist()
    for doc, text in rows:
        joined = [i for (d, p), ids in sorted(parts.items()) if d == doc for i in ids]
        assert joined == [*encode(text or ""), 50256]
    assert len({r["sequence_id"] for r in out}) == len(out)


def test_quality_rules_on_edges(make_docs, spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, words), (4, "a b c " * 30), (5, "\n".join(["x y", "x y", "  ", "X  Y"]) + " " + words)]
    got = {r["doc_id"]: r for r in quality.quality_rules(make_docs(rows), host_col="band").collect()}
    assert [got[i]["kept"] for i in range(1, 6)] == [False, False, True, False, True]
    assert got[4]["n_repeat_words"] == 90 and got[5]["n_dup_lines"] == 1 and got[1]["n_words"] == 0
    boiler = "the same line of boilerplate in every one of these documents, which is long enough to matter here"
    many = [(i, f"{boiler}\n{boiler} again\nunique {i} " + (words if i == 7 else "") + " pad" * 3 + f" {i}") for i in range(40)]
    many = [(i, t + "\n" + " ".join(f"{boiler} {k}" for k in range(3))) for i, t in many]
    out = {r["doc_id"]: r for r in quality.quality_rules(make_docs(many), host_col="band", spare_first=True).collect()}
    assert out[0]["n_removed_chars"] == 0 and out[1]["n_removed_chars"] > 0
    out = {r["doc_id"]: r for r in quality.quality_rules(make_docs(many), host_col="band").collect()}
    assert out[0]["n_removed_chars"] > 0 and not any(r["kept"] for r in out.values())


def test_lines_count_documents_of_a_host(spark):
    line = "a line that many of the documents hold"
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{line}\n{body} {i}", "a") for i in range(25)] + [(i, f"{line}\n{line}\n{body} x", None) for i in range(100, 126)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, key int")
    out = {r["doc_id"]: r["n_removed_chars"] for r in quality.quality_rules(df).collect()}
    assert {out[i] for i in range(25)} == {0} and {out[i] for i in range(100, 126)} == {2 * len(line) + len(f"{body} x")}
    first = df.join(quality.quality_rules(df), "doc_id")
    left = first.select("doc_id", quality.without_lines(F.col("text"), F.col("source"), F.col("removed_lines")).alias("t"))
    texts = {r["doc_id"]: r["t"] for r in left.collect()}
    assert texts[0] == rows[0][1] and texts[100] == ""
    assert quality.quality_rules(df.limit(0)).collect() == []


def test_repeats_of_a_very_long_text_are_exact(make_docs):
    words = " ".join(f"w{i}" for i in range(1_000_000)) + " w5 w6 w7"
    row = quality.quality_rules(make_docs([(1, words)]), host_col="band").first()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (1_000_003, 6, True)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 300).astype(np.uint64)
    sketch = fast_similarity_sketch(np.concatenate([pool[:240], pool[60:]]), np.array([240, 240]), 512)
    assert (sketch < 2**64 - 1).all() and abs((sketch[0] == sketch[1]).mean() - 0.6) < 0.1
    tiny = fast_similarity_sketch(pool[:1], np.array([1, 0]), 64)
    assert (tiny[0] < 2**64 - 1).all() and (tiny[1] == 2**64 - 1).all()


def test_long_words_of_equal_polynomials_differ():
    """Words that a polynomial modulo 2^64 can't tell apart, whatever its base."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    data = np.frombuffer((one + two + one).encode(), np.uint8)
    starts = np.array([0, 4096, 8192])
    with np.errstate(over="ignore"):
        hashes = subwords.W.word_hashes(data, starts, starts + 4096)
    assert hashes[0] == hashes[2] != hashes[1]


def test_near_duplicates_of_odd_tables(make_docs):
    assert near_duplicates(make_docs([])).collect() == []
    words = " ".join(f"w{i}" for i in range(300_000))
    rows = [(5, words), (3, words + " more"), (9, "a " * 100_000), (7, None)]
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_duplicates(make_docs(rows)).collect()}
    assert got == {5: (3, 299_996), 3: (3, 299_997), 9: (9, 1), 7: (7, 0)}


def _jaccard(a, b, width):
    cut = lambda t: {tuple(t[i : i + width]) for i in range(len(t) - width + 1)} or ({tuple(t)} if t else set())
    a, b = cut(a.lower().split()), cut(b.lower().split())
    return 100 * len(a & b) >= 80 * len(a | b) and bool(a)


def test_near_duplicates_equal_brute_force(make_docs):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 4000, 200)]
    rows = [(100, " ".join(base)), (3, None), (4, ""), (5, "one two"), (6, "One two"), (7, " ")]
    for i in range(60):
        text = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 9)):
            text[at] = f"e{i}_{at}"
        rows.append((200 + i, " ".join(text)))
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_duplicates(make_docs(rows), width=4).collect()}
    parent = {d: d for d, _ in rows}
    for _ in rows:
        for i, (a, s) in enumerate(rows):
            for b, t in rows[:i]:
                if s and t and _jaccard(s, t, 4):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {d: (parent[d], parent[d] == d) for d, _ in rows}


def test_language_of_held_out_texts(spark, documents):
    texts = {"en": "the house of and with there which ", "de": "das haus und die nicht schön für ", "fr": "la maison été dans avec les où "}
    rng = np.random.default_rng(5)
    rows = []
    for i in range(360):
        lang = list(texts)[i % 3]
        rows.append((i, " ".join(rng.choice(texts[lang].split(), 30)), lang))
    rows += [(1000, None, "en"), (1001, "123 !! ½ ² Ⅷ", None), (1002, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.identify(df).collect()}
    held = [r for r in rows[:360] if got[r[0]]["held_out"]]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, *_ in rows)
    assert np.mean([got[d]["lang_pred"] == lang for d, _, lang in held]) >= 0.95
    assert [(got[d]["lang_pred"], got[d]["score"]) for d in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert language.identify(df.limit(0)).collect() == []
    model = language.fit_on(df, "doc_id", "text", "lang")
    twice = df.union(df).withColumn("score", F.lit(1)).withColumn("accepted", F.lit("x"))
    assert language.identify(twice, model=model).count() == 2 * df.count()
    kept = language.accepted_documents(twice, model=model)
    assert kept.columns == twice.columns and {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["accepted"]}
    assert len([d for d in got if got[d]["accepted"]]) >= 355
    # Words of random letters are no language.
    strange = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(40)) for _ in range(60)]
    names, scores = model.predict(strange)
    assert model.accepts(names, scores).mean() < 0.1
    assert model.predict(["½ ² "])[0] == ["und"]


def test_licences_of_varied_notices(documents):
    model = licences.fit([line for _, t, *_ in documents[:80] for line in t.split("\n")])
    texts = [
        "Some words.\nReleased under the MIT License.\nMore words.", "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", None, "",
        "The quick brown fox jumps over the lazy dog and the license plate of a car.",
    ]
    found = model.find(pa.array(texts, pa.string()))
    assert [[x["family"] for x in f if x["confirmed"]] for f in found] == [["mit"], ["apache"], ["gpl"], ["cc-by-nc"], [], [], []]
    span = found[0][0]
    assert texts[0].encode()[span["start"] : span["end"]].decode() == "Released under the MIT License."
    wrapped = [
        "// Released under the\n// MIT License.\nint x;", "/*\n * This program is free software; you can redistribute it and/or modify\n"
        " * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n"
        " * (at your option) any later version.\n */\nint main;",
        "# Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted, provided that the above\n"
        "# copyright notice and this permission notice appear in all copies.\n\nimport os",
        "This program is free software; you can redistribute it and/or modify", "the terms of the",
    ]
    found = model.find(pa.array(wrapped, pa.string()))
    assert [[x["family"] for x in f if x["confirmed"]] for f in found] == [["mit"], ["gpl"], ["isc"], [], []]


def test_licence_tables_of_odd_texts(spark, make_docs, documents):
    model = licences.fit([line for _, t, *_ in documents[:80] for line in t.split("\n")])
    rows = [(1, "x\n\nLicensed under CC BY 4.0\n\ny"), (1, "x"), (2, None), (3, ""), (4, "word " * 200_000 + "\nReleased under the MIT License.")]
    df = make_docs(rows).withColumn("found", F.lit(1))
    out = licences.scan_licences(df, model=model)
    assert sorted((r["doc_id"], r["families"]) for r in out.collect()) == [(1, []), (1, ["cc-by"]), (2, []), (3, []), (4, ["mit"])]
    assert licences.scan_licences(df.limit(0)).collect() == []


def test_licences_of_held_out_documents(documents):
    """Precision and recall on documents that the fit hasn't seen, with notices set among their lines."""
    lines = [line for _, t, *_ in documents for line in t.split("\n") if line.strip()]
    model = licences.fit([x for x in lines[::2] if "icens" not in x])
    clean = [x for x in lines[1::2] if "icens" not in x and "GNU" not in x][:600]
    rng = np.random.default_rng(9)
    texts, truth = [], []
    for i in range(0, len(clean) - 3, 3):
        family = list(licences.TEMPLATES)[int(rng.integers(0, len(licences.TEMPLATES)))] if i % 2 else None
        notice = [str(rng.choice(licences.TEMPLATES[family]))] if family else []
        texts.append("\n".join([clean[i], *notice, *clean[i + 1 : i + 3]]))
        truth.append([family] if family else [])
    got = [sorted({x["family"] for x in f if x["confirmed"]}) for f in model.find(pa.array(texts))]
    right = sum(len(set(g) & set(t)) for g, t in zip(got, truth))
    assert right >= 0.95 * sum(map(len, got)) and right >= 0.95 * sum(map(len, truth))


def _neighbours(out):
    got = {}
    for r in out.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    return {q: [ranks[k] for k in range(1, len(ranks) + 1)] for q, ranks in got.items()}


def _exact(ids, rows, q, k=10):
    near = forest.distances(rows, rows[ids.index(q)])
    return [i for _, i in sorted((d, i) for d, i in zip(near.tolist(), ids) if i != q)[:k]]


def test_forest_of_odd_vectors(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(150, 8)).astype(np.float32)
    vectors[20:45] = vectors[19]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(500, None), (501, [0.0] * 8), (502, [float("nan")] + [1.0] * 7), (503, [1.0] * 3), (504, [None] + [1.0] * 7), (-1, [1.0] * 3)]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<float>, shard int")
    got = _neighbours(forest.nearest_neighbours(df, df.vec_id % 10 == 0, trees=6))
    wide = vectors.astype(float)
    assert got == {q: _exact(list(range(150)), wide, q) for q in range(0, 150, 10)}
    assert forest.nearest_neighbours(df.limit(0), df.vec_id % 10 == 0).collect() == []
    few = _neighbours(forest.nearest_neighbours(df.where("vec_id < 4"), df.vec_id == 0))
    assert few == {0: _exact([0, 1, 2, 3], wide[:4], 0)}


def test_forest_climbs_and_does_not_scan():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    rows = centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 16))
    tree = forest.Forest(np.arange(3000), rows, forest.rotations(16, forest.TREES, forest.DIGITS, 5), forest.DIGITS)
    asks = np.arange(0, 3000, 100)
    seen = []
    nearest = tree.nearest
    tree.nearest = lambda some, point, k: seen.append(len(some)) or nearest(some, point, k)
    found = tree.search(asks, rows[asks], 10, forest.RECALL, 5)
    hits = sum(len(set(ids.tolist()) & set(_exact(list(range(3000)), rows, q))) for q, (_, ids, _) in zip(asks, found))
    assert hits >= 0.9 * 300 and np.mean(seen[5:]) < 300


def test_longest_prefixes_come_first():
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(500, 16))
    tree = forest.Forest(np.arange(500), rows, forest.rotations(16, 4, forest.DIGITS, 5), forest.DIGITS)
    begin, end = tree.ranges(tree.codes[:50])
    for q in range(50):
        for t in range(4):
            for level in range(forest.DIGITS + 1):
                shift = np.uint64(tree.bits * (forest.DIGITS - level))
                alike = set(np.flatnonzero(tree.codes[:, t] >> shift == tree.codes[q, t] >> shift).tolist()) if level else set(range(500))
                assert set(tree.order[begin[level, q, t] : end[level, q, t], t].tolist()) == alike
    held = tree.held(begin, end)
    assert (np.diff(held, axis=1) >= 0).all() and (held[:, -1] == 4 * 500).all()


@pytest.mark.parametrize("n", [10_000, 50_000])
def test_forest_recall_on_noise_by_default(spark, n):
    vectors = np.random.default_rng(11).normal(size=(n, 64)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(vectors))}))
    asks = range(0, n, max(n // 100, 100))
    got = _neighbours(forest.nearest_neighbours(df, F.col("vec_id").isin(list(asks))))
    wide = vectors.astype(float)
    hits = sum(len(set(got[q]) & set(_exact(list(range(n)), wide, q))) for q in asks)
    assert hits / (10 * len(asks)) >= 0.9


def test_forest_splits_hot_vectors_and_queries(spark, monkeypatch):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(900, 8))
    vectors[:300] = 1 + 1e-3 * rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(forest, "SHARD_BYTES", 64 * 64)
    monkeypatch.setattr(forest, "QUERY_BYTES", 64 * 6)
    got = _neighbours(forest.nearest_neighbours(df, df.vec_id % 50 == 0))
    assert got == {q: _exact(list(range(900)), vectors, q) for q in range(0, 900, 50)}


def test_pages_render_blocks_lists_tables_and_visibility():
    page = (
        "<html><head><title>no</title><body><h1>A</h1><p>one <b>two</b>\n three<p>para<ul><li>x<li>y<ol start=3><li>n1<li>n2</ol></ul>"
        "<table><tr><th>Name<th>Qty<tr><td>apple<td>3</table><div style='display: none'>no</div><pre>\n a\n   b</pre>"
        "a<br>b &amp; c<script>var t='</p>';</script><span hidden>no</span>"
    )
    assert pages.render(page) == (
        "A\n\none two three\n\npara\n\n- x\n- y\n  3. n1\n  4. n2\n\nName   Qty\napple  3\n\n a\n   b\n\na\nb & c"
    )
    assert pages.render(None) == pages.render("") == ""
    for broken in ("<", "<a href='", "</p>" * 50, "<div>" * 5000 + "x", "<table><td>1<table><tr><td>2", "<!--", "a<b"):
        pages.render(broken)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><thead><th>Name<th>Qty</thead><tbody><td>x<td>y</table>", "Name  Qty\nx     y"),
        ("<table><td>1<td>2<tr><td>3</table>", "1  2\n3"),
        ("<table><tr><form><td>a</td></form></tr></table>z", "a\n\nz"),
        ("<table>one<tr>two<td>x</td><p>three</p></tr><tbody><b>four</b></table>", "onetwo\n\nthree\n\nfour\n\nx"),
        ("<table><caption>cap<tr><td>x<table><td>in</tr></table>y</table>", "cap\nx\n\nin\n\ny"),
        ("<table><tr><td>a<table><tr><td>b</table></td><td>c</table>", "a  c\n\nb"),
        ("<table><tr><table><tr><td>x</table>", "x"),
        ("<table><template><tr><td>no</td></tr></template><tr><td>x</table>", "x"),
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> b", "a x=1 b"),
        ("<svg><title/><defs><text>no</text></defs><g>no<text>yes</text><text><![CDATA[a>b]]></text></g></svg>c", "yes a>b c"),
        ("<svg><path d=1><p>out", "out"),
        ("a<xmp>b &amp; <i>c</i></xmp>d", "a\n\nb &amp; <i>c</i>\n\nd"),
        ("<p style='visibility: hidden'>no <b style='visibility:visible'>yes</b> no</p>x", "yes\n\nx"),
        ("<div style='display:none'>no <b style='visibility:visible'>no</b></div>x", "x"),
        ("<p>pick <select><option>a<option selected>b</select> now", "pick b now"),
        ("<select multiple><optgroup><option>a<option>b</select>", "a b"),
        ("<datalist><option>no</datalist>x", "x"),
        (f"<table><tr><td>{'w' * 60}<td>1<tr><td>v<td>2</table>", f"{'w' * 60}  1\nv{' ' * 61}2"),
        ("<table><tr><td rowspan=2000>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ],
)
def test_every_visible_word_of_odd_pages_appears(page, text):
    assert pages.render(page) == text


@pytest.mark.parametrize("size", [3000, 5000, 10_240, 1_000_000])
def test_long_attribute_values_stay_in_their_tag(size):
    long = "a" * size + "<b>secret</b>'c"
    assert pages.render(f'<div data-x="{long}">visible</div>') == "visible"
    assert pages.render(f'<p data-x = "{long}" hidden>no</p>yes') == "yes"
    assert pages.render(f"<p>don't</p><p don't>one{'x' * size}</p><a href=q?b=\"c>it's</a>").split() == ["don't", "one" + "x" * size, "it's"]


def test_open_quotes_take_linear_time():
    text = pages.render("<a b='c>x</a>" + "<a b=\"c>y</a>" * 40_001)
    assert text.startswith("x") and text.endswith("y")


def test_deep_tables_keep_their_words():
    assert sorted(pages.render("<div>" * (pages.MAX_DEPTH - 2) + "<table><tr><td>x<table>w<td>y</table></table>").split()) == ["w", "x", "y"]
    assert "z" in pages.render("<div>" * 300 + "<table><tr><td>z")
    assert "z" in pages.render("<ul><li>" * 4000 + "z") and "z" in pages.render("<blockquote><table><tr><td>" * 4000 + "z")


def test_page_query(spark):
    df = spark.createDataFrame([(1, "<p>x", "u"), (2, None, "u"), (2, None, "u")], "page_id long, html string, text string")
    assert sorted(tuple(r) for r in pages.extract_text(df).collect()) == [(1, 1, "x"), (2, 0, ""), (2, 0, "")]
    assert pages.extract_text(df.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "<p>" + "word " * 400_000)], "page_id long, html string")
    assert len(pages.extract_text(long).first()["text"]) == 5 * 400_000 - 1


def test_shards_of_odd_tables(make_docs):
    ranks, pattern = path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    assert shards.packed_shards(make_docs([]), ranks, pattern).collect() == []
    rows = [(1, "word " * 60_000), (2, "x"), (2, "x")]
    out = shards.packed_shards(make_docs(rows), ranks, pattern).collect()
    assert sum(r["n_ids"] for r in out) == sum(len([*shards.rank_encoding(ranks, pattern).encode_ordinary(t), 0]) for _, t in rows)


def test_best_fit_decreasing_equals_a_plain_search():
    rng = np.random.default_rng(13)
    sizes = rng.integers(1, 60, 400)
    bins = shards.best_fit_decreasing(sizes, 64)
    left: list[int] = []
    placed: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        fits = [(room, k) for k, room in enumerate(left) if room >= sizes[i]]
        room = min(fits)[0] if fits else None
        if room is None:
            left.append(64 - int(sizes[i]))
            placed.append([i])
        else:
            # Of equal bins the last one that came to this room.
            k = next(k for k in range(len(placed)) if bins[k][: len(placed[k]) + 1] == [*placed[k], i] and left[k] == room)
            left[k] -= int(sizes[i])
            placed[k].append(i)
    assert placed == bins


def test_sum_of_squares_equals_a_plain_search():
    rng = np.random.default_rng(14)
    sizes = rng.integers(1, 30, 300)
    bins, offsets = packing.sum_of_squares(sizes, 40)
    rooms: list[int] = []
    for size, b, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def cost(change):
            after = [r for r in change if 0 < r < 40]
            return sum(after.count(r) ** 2 for r in set(after))

        options = {}
        for k, room in enumerate([*rooms, 40]):
            if room >= size:
                options.setdefault(room, cost([*rooms[:k], room - size, *rooms[k + 1 :]]))
        if size < 40:
            assert options[40 - offset] == min(options.values())
        if b == len(rooms):
            rooms.append(40)
        assert offset == 40 - rooms[b]
        rooms[b] -= size


def test_packing_encodes_little_text_at_once(make_docs, documents, monkeypatch):
    docs = make_docs([(1, "a")])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = packing.token_pieces(docs, "doc_id", "text", path("word_bpe_49k.json"), 10**9, 0, False)
    text = " ".join(t for _, t, *_ in documents if t)[:4000]
    texts = pa.array([text[k:] + text[:k] for k in range(1000)])
    _, counts = tokens.word_tokenizer(path("word_bpe_49k.json")).encode(texts)
    tracemalloc.start()
    try:
        parts = list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(1000)), texts], ["doc_id", "text"])])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [n for part in parts for n in part.column(3).to_pylist()] == (counts + 1).tolist()
    assert most < 64 << 20


def test_packing_of_repeated_ids(make_docs):
    out = packing.pack_documents(make_docs([(1, "same text"), (1, "same text"), (2, "word " * 3000)]), path("word_bpe_49k.json")).collect()
    spans = {}
    for r in out:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_language_of_many_labels(spark):
    rows = [(i, f"text number {i} of a language", f"l{i % 30:02d}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit_on(df, "doc_id", "text", "lang").languages == tuple(f"l{k:02d}" for k in range(30))
