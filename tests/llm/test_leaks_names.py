"""Leaks with names at the beginning of sentences, and more than one copy of a template."""

from linkwright.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
APPLES = "Anna bought 12 apples at the market. Anna gave 5 apples to her brother Tom. Tom ate 2 of them on the way home. How many apples does Anna have left?"


def swapped(text, **to):
    for old, new in to.items():
        text = text.replace(old, new)
    return text


def leaked(spark, docs, items):
    kept = D.without_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return {i for i, _ in docs} - {r.doc_id for r in kept}


def test_names_that_begin_sentences(spark):
    renamed = swapped(APPLES, Anna="Maria", Tom="Paul").replace("12", "31").replace("5", "8")
    docs = [
        (1, renamed), (2, APPLES), (3, "Visit The Hague and see How Anna lives. " + APPLES), (4, swapped(renamed, Paul="Maria")),
        (5, "Nobody bought apples at the market today. Tom stayed at home."), (6, APPLES.replace("at the market", "in The market")),
        (7, f'"{renamed}"'),
    ]
    assert leaked(spark, docs, [(1, APPLES)]) == {1, 2, 3, 6, 7}


def test_a_later_copy_with_consistent_slots(spark):
    item = "If Anna has 3 apples and Bob has 12 apples, how many kg do Anna and Bob carry in total today?"
    mixed = "If Carl has 7 apples and Dora has 15 apples, how many miles do Eve and Frank carry in total today?"
    changed = item.replace("in total", "all in all")
    docs = [(1, f"{mixed} Next one. {item}"), (2, f"{mixed} Next one. {mixed}"), (3, f"{mixed} Next one. {changed}"), (4, f"{item} {mixed}")]
    items = [(1, item)]
    assert leaked(spark, docs, items) == {1, 3, 4}
    found = {r.doc_id: r for r in D.find_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert len(found) == 4 and found[1].consistent and found[1].slots == found[4].slots and not found[2].consistent
