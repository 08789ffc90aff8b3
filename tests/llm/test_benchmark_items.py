import pytest

from acervo.llm import decontamination as dc
from tests.llm.test_decontamination import ITEM, SAME

OTHER = "Every autumn the tall gardener carried wet leaves behind the broken wall while children watched quietly from an open window above the narrow road and nobody ever asked why the dog had stopped barking at strangers who passed by so slowly that even birds came down to eat beside them near our gate and then flew on."


def test_repeated_items_and_shared_or_null_identifiers(spark):
    docs = spark.createDataFrame([(1, SAME), (2, OTHER), (3, "nothing of the kind")], "doc_id long, text string")

    def held(items):
        return {r.doc_id: (r.n_items, r.item_id, r.coverage) for r in dc.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}

    once = held([(7, ITEM), (8, OTHER)])
    assert once[1][:2] == (1, 7) and once[2] == (1, 8, 1.0) and once[3] == (0, None, 0.0)
    assert held([(7, ITEM)] * 3 + [(8, OTHER)] * 2) == once
    shared = held([(7, ITEM), (7, OTHER)])
    assert shared[1] == once[1] and shared[2] == (1, 7, 1.0)
    null = held([(None, ITEM), (None, OTHER)])
    assert null[1] == (1, None, once[1][2]) and null[2] == (1, None, 1.0) and null[3][0] == 0
    assert [r.doc_id for r in dc.decontaminated(docs, spark.createDataFrame([(None, ITEM), (None, ITEM), (None, OTHER)], "item_id long, text string")).collect()] == [3]


@pytest.mark.parametrize("most", [dc.MOST_HASHES, 0])
def test_items_without_a_good_window_are_found_as_a_whole(spark, most):
    names = "Anna 12 Peter 5 km Hugo 7 kg Maria 40 miles Clara 9 Otto 3"
    items = [(1, "What is 12 + 7 * 3?"), (2, names), (3, "Name the capital."), (4, ITEM), (5, ""), (6, None), (7, names + " 4"), (3, "Name the capital.")]
    texts = ["He asked: what is 12 + 7 * 3? Nobody knew.", "So " + names + " is the list.", "What is 12 + 7 * 4?", names[:-2] + " 8", "Please name the capital", "name the old capital", ITEM, "", None, "What is 12 + 7 *", "name the capital, or name the capital"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.item_id, r.coverage) for r in dc.judged(docs, bench, most=most, whole=True).collect()}
    found = {0: 1, 1: 2, 4: 3, 6: 4, 10: 3}
    assert got == {i: (1, found[i], 1.0) if i in found else (0, None, 0.0) for i in range(len(texts))}
    assert sorted(r.doc_id for r in dc.decontaminated(docs, bench, most=most, whole=True).collect()) == [i for i in range(len(texts)) if i not in found]
