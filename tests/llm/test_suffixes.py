import numpy as np
import pytest

from stridelake.llm import suffixes
from stridelake.llm.suffixes import remove_earlier_copies


def brute(rows, length=50):
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if first.setdefault(raw[s : s + length], doc) < doc:
                gone[s : s + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        out[doc] = (len(raw), spans, bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


def found(df):
    return {
        r["doc_id"]: (r["n_bytes"], [(s["start"], s["end"]) for s in r["removed_spans"]], bytes(r["kept"]))
        for r in df.collect()
    }


def test_longest_previous_factors_of_a_known_order():
    text = b"abaabababa"
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))
    common = np.zeros(len(text), np.int16)
    for k in range(1, len(text)):
        a, b = text[order[k - 1] :], text[order[k] :]
        common[k] = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    got = suffixes.longest_previous_factors(common, order)
    for k, i in enumerate(order):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(text) and text[j + n] == text[i + n]:
                n += 1
            best = max(best, n)
        assert got[k] == best


@pytest.mark.parametrize("hot", [64, 1])
def test_equals_brute_force_over_many_chunks(make_docs, documents, hot):
    rows = [(i, t) for i, t, *_ in documents[:120]]
    passage = "a passage of more than fifty bytes that many of the documents share, word for word"
    rows += [(1000 + i, f"{'x' * (i % 7)} {passage}{i}") for i in range(30)]
    rows += [(2000, None), (2001, ""), (2002, "a" * 500), (2003, "ab" + "a" * 400), (2004, "é" * 60), (2005, "é" * 61)]
    # With hot_chunks=1 every anchor that two chunks share travels window by window.
    assert found(remove_earlier_copies(make_docs(rows), chunk_bytes=20_000, hot_chunks=hot)) == brute(rows)


def test_whole_characters_and_carried_columns(make_docs):
    text = "ö" * 40 + "end"
    out = remove_earlier_copies(
        make_docs([(1, text), (2, "x" + text + "y"), (3, None)]), whole_characters=True, carry=["band"]
    ).collect()
    assert {(r["doc_id"], r["kept"], r["band"]) for r in out} == {(1, text, "x"), (2, "xy", "x"), (3, "", "x")}


def test_empty_table(make_docs):
    assert remove_earlier_copies(make_docs([])).collect() == []
