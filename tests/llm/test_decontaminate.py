from __future__ import annotations

import random
import re

import pytest

from framelake.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, items, window):
    """Hit word places and the items found, by looking every window up."""
    w, hit, found = words(text), set(), set()
    for item, content in items:
        v = words(content)
        n = min(len(v), window)
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                if item is not None:
                    found.add(item)
    return len(w), hit, sorted(found)


def draw_case(draw, vocabulary, window):
    some = lambda k: " ".join(draw.choice(vocabulary) for _ in range(k))
    items = [(draw.randint(0, 6), some(draw.randint(0, 3 * window))) for _ in range(draw.randint(0, 8))]
    text = some(draw.randint(0, 40))
    for _, content in items:
        if draw.random() < 0.4:
            text += draw.choice([" ", ", ", "\n"]) + content.upper() + " " + some(draw.randint(0, 5))
    return items, text


def test_automaton_against_all_windows():
    draw = random.Random(9)
    for _ in range(1500):
        window = draw.choice([2, 3, 4])
        items, text = draw_case(draw, ["a", "b", "c", "É", "1"][: draw.randint(2, 5)], window)
        automaton = D.ItemAutomaton([(i, D.words_of(c.encode())) for i, c in items], window)
        spans, found = automaton.scan(D.words_of(text.encode()))
        n, hit, ids = expected(text, items, window)
        assert {p for s, e in spans for p in range(s, e)} == hit
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert sorted(found) == ids
        cut, removed, _ = D.without(text.encode(), automaton)
        assert automaton.scan(D.words_of(cut))[0] == []
        assert len(D.words_of(cut)) == n - removed and removed >= len(hit)


def test_word_class():
    text = "Ab-c_d'É 1x\t\x7f~{z}\x00ſ K"
    assert [w.decode() for w in D.words_of(text.encode())] == words(text)


@pytest.fixture(scope="module")
def case(spark, documents):
    draw = random.Random(10)
    vocabulary = [f"w{i}" for i in range(30)] + ["é"]
    some = lambda k: " ".join(draw.choice(vocabulary) for _ in range(k))
    items = [(i, some(draw.randint(8, 40))) for i in range(12)] + [(50, "short item"), (51, ""), (52, None), (None, some(15)), (3, some(20)), (60, some(12))]
    items.append((61, items[-1][1]))
    rows = [(i, some(60) + (" " + draw.choice(items[:12])[1] if i % 3 else "") + ", " + some(20), "en", "s") for i in range(40)]
    rows += [(100, None, None, None), (101, "", "en", "s"), (None, items[0][1], "en", "s"), (102, "A Short, ITEM here", "en", "s"), (103, items[-1][1] + ".", "en", "s"), (104, some(30) + " " + items[1][1] + " x" * 300_000, "en", "s"), rows[0], rows[0]]
    return rows, items, documents(rows, clashes=True), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, row string")


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 700])
def test_marks(case, block_bytes):
    rows, items, docs, table = case
    got = D.mark(docs.select("doc_id", "text", "row", "hash"), table, block_bytes=block_bytes).collect()
    assert got[0].asDict().keys() == {"doc_id", "row", "hash", "n_words", "spans", "items"}
    flat = lambda i, n, hit, ids: repr((i, n, sorted(hit), ids))
    want = sorted(flat(r[0], *expected(r[1], items, D.WINDOW)) for r in rows)
    assert sorted(flat(r["doc_id"], r["n_words"], {p for s, e in r["spans"] for p in range(s, e)}, r["items"]) for r in got) == want


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 700])
def test_cuts(case, block_bytes):
    rows, items, docs, table = case
    got = D.decontaminate(docs, table, block_bytes=block_bytes)
    assert got.columns == docs.columns
    out = {r["doc_id"]: r for r in got.collect()}
    for i, text, lang, _ in rows:
        n, hit, _ = expected(text, items, D.WINDOW)
        if not hit:
            assert out[i]["text"] == text and out[i]["lang"] == lang
        elif i in out:
            assert expected(out[i]["text"], items, D.WINDOW)[1] == set()
            assert n - len(words(out[i]["text"])) >= len(hit) and out[i]["n_chars"] == len(out[i]["text"])
        else:
            assert len(hit) > 0.2 * n  # what is found and what comes together by cutting
    assert None not in out and 103 not in out  # passages and nothing else
    assert out[102]["text"] == "A  here"


def test_repeated_items_are_taken_once(case, monkeypatch):
    rows, items, docs, table = case
    sizes, block = [], D._block
    monkeypatch.setattr(D, "_block", lambda *a: (lambda b: (sizes.append(len(b[1].value)), b)[1])(block(*a)))
    often = table
    for _ in range(4):
        often = often.unionAll(often)
    marks = lambda items: sorted(repr(r) for r in D.mark(docs.select("doc_id", "text"), items, block_bytes=700).collect())
    assert marks(often) == marks(table)
    assert sum(sizes) == 2 * len({i for i in items if i[1] is not None})


def test_columns_called_like_results_give_way(case):
    _, _, docs, table = case
    got = D.mark(docs.select("doc_id", "text", "spans", "n_words"), table)
    assert got.columns == ["doc_id", "n_words", "spans", "items"] and got.where("n_words IS NULL").isEmpty()


def test_empty_tables(spark, documents, case):
    _, _, docs, table = case
    assert D.decontaminate(documents([]), table).collect() == []
    assert D.mark(documents([]), table).collect() == []
    assert D.decontaminate(docs, table.limit(0)).count() == docs.count()
    assert D.mark(docs.select("doc_id", "text"), table.limit(0)).where("size(spans) > 0 OR size(items) > 0").isEmpty()
