import hashlib

from compare import connect, differences
from reference import SYMBOL_WORD, words_of

from wardledger.llm.decontamination import ORACLE_SQL, decontaminate


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text, SYMBOL_WORD)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, named = words_of(text, SYMBOL_WORD), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    named |= {x for x in own if x is not None}
        sha = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(named), sha, bool(hit)))
    return sorted(out, key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_sql(documents, benchmark, folder):
    columns, extra, missing, rows = differences(decontaminate(documents, benchmark), connect(folder), ORACLE_SQL)
    assert not columns and not extra and not missing and rows == documents.count()


def test_short_items_ties_and_nulls(spark, odd):
    items = spark.createDataFrame(
        [(1, "one TWO"), (2, "alpha0 beta alpha1 beta alpha2 beta alpha3 beta alpha4 beta alpha5 beta"), (3, None), (4, "..."),
         (5, "beta"), (None, "one two"), (6, "beta alpha7 beta alpha8 beta alpha9 beta alpha10 beta alpha11"), (6, "beta")],
        "item_id bigint, text string",
    )
    found = sorted((tuple(r) for r in decontaminate(odd, items).collect()), key=str)
    assert found == expected(pairs(odd, "doc_id"), pairs(items, "item_id"))


def test_every_offset_of_a_shared_window_is_found(spark):
    item = [f"w{i * 37 % 101}" for i in range(60)]
    docs = [(i, " ".join(["x"] * i + item[i : i + 10] + ["y"])) for i in range(50)]
    docs += [(100 + i, " ".join(["x"] * 3 + item[i : i + 9] + ["y"] * 9)) for i in range(50)]
    found = decontaminate(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"),
    ).collect()
    assert {r["doc_id"]: r["n_hit"] for r in found} == {i: 10 if i < 100 else 0 for i, _ in docs}


def test_no_rows(nothing, benchmark, documents):
    assert decontaminate(nothing, benchmark).count() == 0
    assert not decontaminate(documents, benchmark.limit(0)).where("contaminated").count()
