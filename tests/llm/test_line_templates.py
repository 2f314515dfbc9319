from catalogflow.llm import line_templates
from catalogflow.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def test_equals_sql(spark):
    name = "op8_line_templates"
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) is None


def test_variable_fields_share_a_template(spark):
    own = [" ".join(c + x for x in "abcde") for c in "abcdefghijkl"]
    rows = [(i, f"{own[i]}\nPage {i} of {i * 7}") for i in range(12)]
    rows += [(50 + i, f"Signed in as user {n} today") for i, n in enumerate("ann bob cid".split())]
    rows += [(60 + i, "Signed in as user dan today") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_templates.drop_lines(docs).collect()}
    # Page numbers go from all but the first document; the lines' own words stay where they vary.
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    assert got[1].text == own[1]
    # Names without digits are generalised by the leaf, since 4 of 5 tokens are equal.
    assert got[50].text == rows[12][1]
    assert all(got[i].text == "" and got[i].n_dropped == 1 for i in (51, 52, *range(60, 69)))


def test_rare_and_short_lines_stay(spark):
    rows = [(i, "short line\na line that is found in nine") for i in range(9)]
    rows += [(i, "short line") for i in range(20, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(r.n_dropped == 0 for r in line_templates.drop_lines(docs).collect())


def test_long_lines_recur_from_two_documents_on(spark):
    long = " ".join(f"w{c}" for c in "abcdefghijklmnopqrst")
    figures = " ".join(str(i) for i in range(25))
    rows = [(i, f"{long} {i}\n{figures}\n{long[:-3]}") for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_templates.drop_lines(docs, long_tokens=20).collect()}
    # Figures are no tokens of their own, and 19 tokens are too few.
    assert got[1].text == rows[0][1]
    assert got[2].text == f"{figures}\n{long[:-3]}"


def test_odd_rows(odd, empty):
    got = line_templates.drop_lines(odd, min_docs=2).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        (r.doc_id or 0, r.text or "") for r in odd.collect()
    )
    assert {r.doc_id: r.n_lines for r in got}[1] == 0
    assert [c for c in odd.columns if c not in got[0].__fields__] == []
    assert line_templates.drop_lines(empty).count() == 0


def test_main_path_has_no_python(sample):
    plan = line_templates.drop_lines(sample)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_copies_keep_the_lines_they_share(spark):
    """A copy is left for the near-duplicate search; a shared passage in another text still goes."""
    words = lambda a, n: " ".join(f"{a}w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    lines = [words(c, 30) for c in "abcde"]
    rows = [
        (1, "\n".join(lines)),
        (2, "\n".join([*lines[:4], words("x", 30)])),
        (3, "\n".join([words(c, 40) for c in "fgh"] + [lines[0]])),
        (4, "\n".join([*lines, "short"])),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def left(**settings):
        kept = line_templates.drop_lines(docs, long_tokens=20, **settings)
        return {r.doc_id: (r.text.split("\n") if r.text else [], r.n_dropped) for r in kept.collect()}

    assert left()[2] == ([words("x", 30)], 4) and left()[4] == (["short"], 5)
    found = left(copy_share=0.4)
    assert {d: found[d][0] for d in (1, 2, 4)} == {d: t.split("\n") for d, t in rows if d != 3}
    assert found[3] == ([words(c, 40) for c in "fgh"], 1)
