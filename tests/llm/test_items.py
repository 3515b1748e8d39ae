"""Every test item is searched, whatever its length and its id."""

from __future__ import annotations

from indicatorlake.llm import leaks


def found(spark, make_docs, items, docs, kind="long", **more):
    benchmark = spark.createDataFrame(items, f"item_id {kind}, text string")
    rows = leaks.find_leaks(make_docs(docs), benchmark, ["doc_id"], **more).collect()
    return {r.doc_id: [(x.item, x.distance) for x in r.leaks] for r in rows}


def test_short_items_nameless_items_and_all_texts_of_an_id(spark, make_docs):
    items = [(1, "capital is Paris"), (7, "first text of the item with two texts"), (7, "the second one that it has as well, a longer text"),
             (None, "an item that nobody gave any number to"), (8, "... !"), (9, None), (10, "Paris"), (3, "capital  is PARIS!")]
    docs = [(0, "the capital is, paris"), (1, "capital was Paris"), (2, "here the second one that it has as well a longer text ends"), (3, "an item that nobody gave any number to"),
            (4, "first text of the item with two texts. The second one that it has as well, a longer word"), (5, "nothing"), (6, None)]
    expected = {0: [(1, 0), (3, 0), (10, 0)], 1: [(10, 0)], 2: [(7, 0)], 3: [(None, 0)], 4: [(7, 0)], 5: [], 6: []}
    for block_bytes in (leaks.BLOCK_BYTES, 60):
        assert found(spark, make_docs, items, docs, block_bytes=block_bytes) == expected


def test_ids_keep_their_type(spark, make_docs):
    items = [("a/1", "some words of a first item here"), ("", "some words of a second item here"), ("b", "some words of a first item here")]
    docs = [(0, "some words of a first item here"), (1, "x some words of a second item here y")]
    assert found(spark, make_docs, items, docs, "string") == {0: [("", 1), ("a/1", 0), ("b", 0)], 1: [("", 0), ("a/1", 1), ("b", 1)]}
