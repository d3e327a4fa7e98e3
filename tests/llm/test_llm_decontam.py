import pyarrow as pa

from churnlens.llm import decontam, queries
from churnlens.llm.decontam import templates, windows
from churnlens.llm.text import texts_of

ITEM = (
    "A farmer named Alice Brown has 12 apples and gives 3 kg of them to Bob before the market opens. "
    "How many apples does Alice keep after Bob has taken what was promised to him?"
)
CLEAN = "The market opens late today and nobody knows how many people will come before the evening falls over the town."


def found(text):
    return templates(texts_of(pa.array([text])))


def test_placeholders():
    a, b = found("We saw Alice Brown eat 1,250.5 kg of rice"), found("We saw Bob eat seven pounds of rice")
    assert a.hashes.tolist() == b.hashes.tolist() and a.values.tolist() != b.values.tolist()
    assert a.slot.tolist() == [False, False, True, False, True, True, False, False]
    assert found("Alice left.").slot.tolist() == [False, False]  # the first word of a sentence tells nothing
    assert found("m 3 m").slot.tolist() == [False, True, True]
    assert len(found("").hashes) == 0 == len(found(None).hashes)


def test_windows_of_holes_count_by_value():
    (x, _), (y, _) = windows(found("It is 1 2 3 4 5 6"), 8), windows(found("It is 9 8 7 6 5 4"), 8)
    assert x.tolist() != y.tolist()


def rows(df):
    return {r["doc_id"]: (r["contaminated"], r["item_ids"]) for r in df.collect()}


def test_reparameterised_questions(spark):
    swapped = ITEM.replace("Alice", "Mary").replace("Brown", "Smith").replace("Bob", "Tom").replace("12", "480").replace("3 kg", "7 pounds")
    docs = [
        (1, f"Before. {ITEM} After."), (2, f"Before. {swapped} After."), (3, CLEAN), (4, None), (5, ""),
        (6, ITEM[: len(ITEM) // 4]), (None, ITEM), (None, CLEAN), (8, "x " * 200_000 + ITEM), (9, ITEM), (9, ITEM), (10, "one two"),
        (11, "Here five plain words stand alone"),
    ]
    items = [(70, ITEM), (71, ITEM), (72, None), (None, CLEAN), (73, "one two"), (74, ""), (75, "five plain words stand")]
    d = spark.createDataFrame([(*r, "z", 0) for r in docs], "doc_id long, text string, own string, item int")
    b = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, hash int")
    got = decontam.flag(d, b)
    assert got.count() == len(docs)
    by_id = rows(got.where("doc_id is not null"))
    assert {i for i, r in by_id.items() if r[0]} == {1, 2, 8, 9, 11}
    assert by_id[1][1] == by_id[2][1] == [70, 71] and by_id[11][1] == [75] and by_id[3][1] == []
    assert sorted(r["contaminated"] for r in got.where("doc_id is null").collect()) == [False, True]
    kept = decontam.remove(d, b)
    assert kept.columns == d.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 10]
    assert decontam.flag(d.limit(0), b).count() == 0 == decontam.remove(d, b).where("doc_id = 1").count()
    assert not any(r["contaminated"] for r in decontam.flag(d, b.limit(0)).collect())


def test_inconsistent_slots_are_no_match(spark):
    item = " and then ".join(f"the man called Alice went to see part {i} of the old town" for i in "abcdef")
    names = iter(["Bob", "Carl", "Dora", "Emil", "Fred", "Gina"])
    other = " and then ".join(p.replace("Alice", next(names)) for p in item.split(" and then "))
    same = item.replace("Alice", "Zoe")
    d = spark.createDataFrame([(1, other), (2, same)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {i: r[0] for i, r in rows(decontam.flag(d, b)).items()} == {1: False, 2: True}
    worst = decontam.matches(d, b).where("id = 1").first()
    assert worst["matched"] >= 8 and worst["consistent"] < decontam.CONSISTENT


def test_copies_in_another_case(spark):
    """Lower- and upper-cased copies, also with other figures; other names in lower case are no copy."""
    plain = "every reader of the old paper knew that the price of bread rose before the harvest came in"
    others = ITEM.replace("Alice Brown", "Xenia Yardley").replace("Alice", "Xenia").replace("Bob", "Quentin")
    docs = [ITEM.lower(), ITEM.upper(), f"Before. {ITEM.lower().replace('12', '40')} After.", ITEM, others.lower(),
            plain.upper(), plain.title(), CLEAN, CLEAN.upper(), None, ""]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame([(70, ITEM), (71, plain)], "item_id long, text string")
    got = rows(decontam.flag(d, b))
    assert [got[i][1] for i in range(len(docs))] == [[70]] * 4 + [[], [71], [71]] + [[]] * 4
    found = {r["id"]: r for r in decontam.matches(d, b).where("item = 70").collect()}
    assert found[0]["matched"] == found[0]["windows"] and found[3]["matched"] == found[3]["windows"]


def test_copies_after_variants(spark):
    item = " and then ".join(f"the man called Alice went to see part {i} of the old town" for i in "abcdef")
    parts = item.split(" and then ")
    names = ["Bob", "Carl", "Dora", "Emil", "Fred", "Gina"]
    other = " and then ".join(p.replace("Alice", n) for p, n in zip(parts, names))
    variant = " and then ".join(p.replace("Alice", n) for p, n in zip(parts[:4], names))
    renamed = item.replace("Alice", "Zoe")
    far = " plain words" * 100 + ". "
    d = [(1, f"{variant}. {item}"), (2, f"{variant}. {renamed}"), (3, f"{variant}.{far}{variant}"), (4, f"{other}. {item}"),
         (5, f"{other}.{far}{other}.{far}{renamed}"), (6, f"{other}. {other}"), (None, f"{variant}. {item}"), (None, f"{variant}. {item}")]
    d = spark.createDataFrame(d, "doc_id long, text string")
    got = decontam.flag(d, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert rows(got.where("doc_id is not null")) == {i: (i not in (3, 6), [] if i in (3, 6) else [1]) for i in range(1, 7)}
    assert [r["contaminated"] for r in got.where("doc_id is null").collect()] == [True, True]


def test_query_finds_planted_items(spark, data_dir):
    """Against a plain search for runs of eight words."""
    got = rows(queries.QUERIES["op3_decontamination"](spark, data_dir))

    def plain(text):
        return [w.strip(".,!?;:*%&$#").lower() for w in (text or "").split()]

    index, total = {}, {}
    for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect():
        w = plain(r["text"])
        total[r["item_id"]] = len(w) - 7
        for i in range(len(w) - 7):
            index.setdefault(tuple(w[i : i + 8]), set()).add(r["item_id"])
    for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect():
        w, hits = plain(r["text"]), {}
        for i in range(len(w) - 7):
            for item in index.get(tuple(w[i : i + 8]), ()):
                hits.setdefault(item, set()).add(tuple(w[i : i + 8]))
        want = sorted(i for i, h in hits.items() if len(h) >= 0.5 * total[i] or len(h) >= 8)
        assert got[r["doc_id"]] == (bool(want), want)
