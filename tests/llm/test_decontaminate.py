import hashlib
import re

from messy import empty, messy

from ratingloom.llm.decontaminate import contamination, decontamination_stage, find_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[s : s + 10]), set()).add(str(item) if item is not None else "null")
    result = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for win, owners in windows.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    names |= owners
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        result.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(map(str, result))


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [
    (1, None), (2, ""), (3, "one two three"), (4, " ".join(f"alpha{i}" for i in range(50, 75))),
    (5, "Alpha3 ALPHA4, alpha5"), (5, " ".join(f"passage{i}" for i in range(5, 17))), (None, "a row without ID"),
    (7, "no such words at all"), (8, "row row row"), (10, "und3 word3 und4"),
]


def test_same_as_brute_force_on_messy_rows(spark):
    docs = messy(spark)
    got = contamination(docs, items_of(spark, ITEMS)).drop("n_near").collect()
    assert sorted(str(tuple(r)) for r in got) == expected([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_repeated_words_and_overlaps(spark):
    docs = [(1, "a a a a a a a a a a a a b"), (2, "b a a a a a a a a a a"), (3, "a b a b a b a b a b a b a b")]
    items = [(1, "a a a a a a a a a a a"), (2, "a b a b a b a b a b"), (3, "b")]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), items_of(spark, items))
    assert sorted(str(tuple(r)) for r in got.drop("n_near").collect()) == expected(docs, items)


def test_proximity_needs_most_words_in_place(spark):
    item = "r1 r2 r3 r4 r5 r6 r7 r8 r9 r10"
    docs = [(1, item.replace("r5", "x")), (2, item.replace("r5", "x").replace("r6", "y").replace("r7", "z")), (3, item)]
    docs.append((4, "r5 r6 r7 " * 9))  # candidates are found by the rarest words, so those that differ are frequent
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in contamination(frame, items_of(spark, [(1, item)])).collect()}
    assert got[1].n_near == 10 and not got[1].contaminated
    assert got[2].n_near == 0 and got[3].n_near == 10 and got[3].contaminated


def test_stage_drops_contaminated_documents_only(spark):
    docs = messy(spark)
    kept = decontamination_stage(docs, items_of(spark, ITEMS))
    assert kept.columns == docs.columns
    flags = {(r.doc_id, r.n_words): r.contaminated for r in contamination(docs, items_of(spark, ITEMS)).collect()}
    want = sorted(str(r.doc_id) for r in docs.collect() if not flags[(r.doc_id, len(words(r.text)))])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_tables(spark):
    none = items_of(spark, [])
    assert contamination(empty(spark), items_of(spark, ITEMS)).count() == 0
    assert not contamination(messy(spark), none).where("contaminated").count()
    assert decontamination_stage(messy(spark), none).count() == messy(spark).count()


def test_hot_terms_do_not_multiply_candidates(spark):
    """A frequent word next to rare ones is not what candidates are looked up by."""
    docs = spark.range(200).selectExpr("id as doc_id", "concat(repeat('the ', 50), 'rare', id) as text")
    items = items_of(spark, [(1, "the the rare7")])
    _, matches = find_matches(docs, items)
    assert [(r.item_id, r.exact) for r in matches.collect()] == [("1", [48, 49, 50])]
