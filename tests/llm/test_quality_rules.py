from conftest import SMALL, database
from llm_tables import nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from basketflow.llm import quality_rules as q


def test_query(spark):
    ours = sorted(tuple(r[n] for n in sorted(r.asDict())) for r in q.op4_quality_rules(spark, SMALL).collect())
    db = database(SMALL).execute(q.OP4_SQL)
    names = [c[0] for c in db.description]
    theirs = sorted(tuple(row[names.index(n)] for n in sorted(names)) for row in db.fetchall())
    assert ours == theirs


def covered(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = [i for i, g in enumerate(grams) if grams.count(g) > 1]
    return len({i + k for i in twice for k in range(3)})


def test_repeated_words(spark):
    texts = ["a b c a b c", "a a a a", "a a a", "a b", "", "a b c d e a b c x b c d", "x a b c y a b c z a b c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", q.repeated_words(q.words_of(F.col("t"))).alias("n"))
    assert {r.t: r.n for r in rows.collect()} == {t: covered(t.split()) for t in texts}


def hosts(spark):
    """Two hosts: on ``a`` a line stands in every document, one of them copied often; on ``b`` in one."""
    line = "Subscribe  to our NEWSLETTER now"
    body = [" ".join(f"{w}{i}x{k}" for k, w in enumerate("some words that this document has alone".split() * 9)) for i in range(60)]
    rows = [(i, f"{line}\n{body[i]}", "a") for i in range(30)]
    rows += [(100 + i, f"subscribe to our newsletter now \n{body[31]}", "a") for i in range(40)]
    rows += [(200, f"{line}\n{body[32]}", "b"), (201, "\n".join([line] * 15 + body[33].split()[:60]), "a"), (202, "\n".join([line] * 30 + body[34].split()[:60]), "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_frequent_lines(spark):
    rows = {r.doc_id: r for r in q.rate(hosts(spark)).collect()}
    assert rows[0].n_removed_words == 5 and rows[0].kept and "NEWSLETTER" not in rows[0].clean_text
    assert rows[100].n_removed_words == 5 and rows[100].kept  # its own line is in one document, however often copied
    assert rows[200].n_removed_words == 0 and "NEWSLETTER" in rows[200].clean_text
    assert rows[202].n_removed_words == 150 and not rows[202].kept


def test_joined_by_shuffle_beyond_the_bound(spark, monkeypatch):
    before = {tuple(r) for r in q.rate(hosts(spark)).collect()}
    monkeypatch.setattr(q, "BROADCAST_LINES", -1)
    assert {tuple(r) for r in q.rate(hosts(spark)).collect()} == before


def test_a_line_of_many_documents_goes_from_any_host(spark):
    """In a host so large that no line is in its share of documents."""
    line = "one line that stands here and there"
    rows = [(i, (f"{line}\n" if i < 30 else "") + f"text{i} " * 60, "large") for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert not q.frequent_lines(docs).collect()
    assert q.frequent_lines(docs, any_documents=30).count() == 0
    removed = {r.doc_id: r.n_removed_words for r in q.rate(docs, any_documents=25).collect()}
    assert all(removed[i] == (7 if i < 30 else 0) for i in range(1600))


def test_odd_tables(spark, odd, nothing):
    rows = q.rate(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[4].n_words, by_id[5].n_words, by_id[6].n_words, by_id[6].n_dup_lines) == (0, 0, 0, 0)
    assert by_id[4].base_failed and not by_id[4].kept and by_id[4].clean_text == ""
    assert (by_id[9].n_words, by_id[9].n_repeat_words) == (4000, 4000)
    assert q.rate(nothing).count() == 0


def test_no_python_in_the_plan(spark):
    assert "Python" not in q.op4_quality_rules(spark, SMALL)._jdf.queryExecution().toString()
