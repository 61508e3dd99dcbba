"""Golden results on small inputs and the edge lines of SURVEY §2.0."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkdeck.operators import linalg, ratings, relational, words
from sparkdeck.sources.delimited import RATING_USER_LAYOUTS, parse_by_content, parse_delimited, parse_items, parse_pipe_users

TXN = ["C7,book,640,2024-11-02", "C3,lamp,1750.5,2024-11-03", "C9,desk,3120,2024-11-03", "C2,mug,95,2024-11-09"]
TXN_A, TXN_B = TXN[:3], TXN[1:]


def _values(df, col="value"):
    return sorted(r[col] for r in df.collect())


def test_filter_amount_golden(lines):
    assert _values(relational.filter_amount(lines(TXN))) == sorted(TXN[1:3])


def test_filter_amount_edges(lines):
    edge = TXN + ["U5,I5,2000,", "\tU6,I6,2000,d\t", "U9,I9,NaN,d", "", "   ", "U8,I8,1000,d"]
    got = _values(relational.filter_amount(lines(edge)))
    assert got == sorted(TXN[1:3] + ["\tU6,I6,2000,d\t"])  # padded line kept untrimmed


def test_filter_amount_bad_number_fails_or_skips(lines):
    bad = lines(TXN + ["U7,I7,abc,d"])
    with pytest.raises(PySparkException):
        relational.filter_amount(bad).collect()
    assert _values(relational.filter_amount(bad, on_bad="skip")) == sorted(TXN[1:3])


def test_project_distinct_golden(lines):
    got = relational.project_distinct(lines(TXN + TXN[:2])).collect()
    assert sorted((r.user, r.amount) for r in got) == [("C2", "95"), ("C3", "1750.5"), ("C7", "640"), ("C9", "3120")]


def test_set_operations_golden(lines):
    a, b = lines(TXN_A + [TXN_A[0] + "  "]), lines(TXN_B)
    assert len(_values(relational.union_lines(a, b))) == 4
    assert _values(relational.intersect_lines(a, b)) == sorted(TXN[1:3])
    assert _values(relational.difference_lines(a, b)) == [TXN[0]]
    assert _values(relational.difference_lines(b, a)) == [TXN[3]]


RATINGS_SMALL = ["ann,P,5", "ben,P,2", "cat,Q,1", "dan,Q,4", "eve,P,4"]


def test_item_rating_stats_golden(lines):
    r = parse_delimited(lines(RATINGS_SMALL), ",", [("user_id", "string"), ("item_id", "string"), ("rating", "int")],
                        arity=3)
    got = {x.item_id: x.stats for x in ratings.item_rating_stats(r).collect()}
    assert got == {"P": "3.7,3", "Q": "2.5,2"}


def test_half_up_format(spark):
    r = spark.createDataFrame([("u", 1, 2), ("u", 1, 2), ("u", 1, 3), ("u", 1, 2)], "user_id string, item_id int, rating int")
    assert ratings.item_rating_stats(r).first().stats == "2.3,4"  # 2.25 -> 2.3


@pytest.mark.parametrize("vector,want", [
    ([(1, 2.0), (2, 3.0), (3, 5.0)], {1: 13.0, 2: 17.0}),
    ([(1, 2.0)], {1: 3.0, 2: 0.0}),
    ([], {1: 0.0, 2: 0.0}),
])
def test_matvec_missing_entries_count_zero(spark, vector, want):
    m = spark.createDataFrame([(1, 1, 1.5), (1, 3, 2.0), (2, 2, -1.0), (2, 3, 4.0)], "row int, col int, value double")
    v = spark.createDataFrame(vector, "col int, value double")
    assert {r.row: r.value for r in linalg.matvec(m, v).collect()} == want


def test_matvec_duplicate_vector_entry_keeps_last(spark):
    m = spark.createDataFrame([(1, 1, 2.0)], "row int, col int, value double")
    v = spark.createDataFrame([(1, 10.0, 1), (1, 30.0, 2)], "col int, value double, seq int")
    assert linalg.matvec(m, v, order_col="seq").first().value == 60.0


def test_word_golden(lines):
    text = lines(["grey owls hunt", "by night in quiet old woods"])
    got = sorted((r.word, r.length) for r in words.token_lengths(text).collect())
    assert got == sorted((w, len(w)) for w in "grey owls hunt by night in quiet old woods".split())
    wc = words.word_count(text).collect()
    assert len(wc) == 9 and all(r["count"] == 1 for r in wc)


def test_word_count_drops_empty_token(lines):
    text = lines(["", "  x", "x x", "   "])
    assert {r.word: r["count"] for r in words.word_count(text).collect()} == {"x": 3}
    assert sorted(r.word for r in words.token_lengths(text).collect()) == ["", "", "x", "x", "x"]


def test_parse_users_and_items(lines):
    users = parse_pipe_users(lines(["1|31|F|baker|90210", "8|52|M|pilot|00417", "74|44|F|farmer|K1A0B",
                                    "9|19|M|singer|"]))
    got = {r.user_id: r.zip for r in users.collect()}
    assert got == {1: "90210", 8: "00417", 74: "K1A0B"}  # empty last field -> 4 fields -> dropped
    items = parse_items(lines(["1|The Owl|03-May-1991||url|0|1|1", "2|X|d||u|0|0|0"]), ["a", "b", "c"])
    assert {r.item_id: r.categories for r in items.collect()} == {1: ["b", "c"], 2: []}


def test_dispatch_mixed(lines):
    got = parse_by_content(lines(["1\t10\t4.5\t7000001", "1|31|F|baker|90210", "junk"]), RATING_USER_LAYOUTS).collect()
    assert sorted((r.kind, r.user_id, r.rating, r.occupation) for r in got) == [("R", 1, 4.5, None), ("U", 1, None, "baker")]


def test_topk_ties_and_default_label(spark):
    r = spark.createDataFrame([(u, i, v) for i, v in [(3, 5.0), (1, 5.0), (2, 4.0)] for u in range(60)],
                              "user_id int, item_id long, rating double")
    titles = spark.createDataFrame([(3, "three")], "item_id long, title string")
    got = [(x["rank"], x.item_id, x.title) for x in ratings.topk_rated_items(r, titles, k=2).orderBy("rank").collect()]
    assert got == [(1, 1, "MovieID_1"), (2, 3, "three")]


def test_preferred_category_tie_goes_to_first_name(spark):
    r = spark.createDataFrame([(1, 10, 5), (1, 11, 5)], "user_id int, item_id int, rating int")
    u = spark.createDataFrame([(1, "student")], "user_id int, occupation string")
    i = spark.createDataFrame([(10, ["Drama"]), (11, ["Comedy"])], "item_id int, categories array<string>")
    got = ratings.preferred_category(r, u, i, "occupation").collect()
    assert [(x.occupation, x.category, x.n_ratings) for x in got] == [("student", "Comedy", 1)]


def test_avg_rating_by_title_keeps_equal_titles_apart(spark):
    r = spark.createDataFrame([(1, 1, 4), (1, 2, 2)], "user_id int, item_id int, rating int")
    items = spark.createDataFrame([(1, "Same"), (2, "Same"), (3, "")], "item_id int, title string")
    got = sorted((x.item_id, x.avg_rating) for x in ratings.avg_rating_by_title(r, items).collect())
    assert got == [(1, 4.0), (2, 2.0)]


def test_avg_rating_by_group(spark):
    r = spark.createDataFrame([(1, 1, 4), (2, 1, 2), (3, 1, 3)], "user_id int, item_id int, rating int")
    u = spark.createDataFrame([(1, "M"), (2, "F"), (3, "M")], "user_id int, gender string")
    got = {x.gender: x.avg_rating for x in ratings.avg_rating_by_group(r, u, "gender").collect()}
    assert got == {"M": 3.5, "F": 2.0}


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = [tuple(r) for r in relational.schema_report(df).orderBy("ordinal").collect()]
    assert got == [(1, "a", "int", 2), (2, "b", "string", 1)]


def test_first_rows_total_order(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    got = [r.id for r in relational.first_rows(df, ["k", "id"], 3).collect()]
    assert got == [0, 7, 14]


def test_read_lines_latin1(spark, tmp_path):
    from sparkdeck.sources.text import read_lines

    p = tmp_path / "items.txt"
    p.write_bytes("1|Café|x\n2|Señor|y\n".encode("latin-1"))
    assert [r.value for r in read_lines(spark, str(p), encoding="ISO-8859-1").collect()] == ["1|Café|x", "2|Señor|y"]


def test_set_algebra_invariant(lines):
    a = lines(["x,1", "x,1 ", "y,2", "z,3", ""])
    b = lines(["y,2", "w,4", "w,4", "\tz,3"])
    n_union = relational.union_lines(a, b).count()
    n_inter = relational.intersect_lines(a, b).count()
    na = relational.trimmed_lines(a).distinct().count()
    nb = relational.trimmed_lines(b).distinct().count()
    assert n_union == na + nb - n_inter == 4
    assert relational.difference_lines(a, b).count() == na - n_inter


def test_parse_by_content_one_pass(lines):
    from sparkdeck.sources.delimited import RATING_USER_LAYOUTS, parse_by_content

    mixed = lines(["1\t10\t4\t881250949", "2\t10\tx\t1", "1|24|M|technician|85711", "9|29|M|student|", "",
                   "junk", "3\t11\t5"])
    got = sorted((r.kind, r.user_id, r.item_id, r.rating, r.gender)
                 for r in parse_by_content(mixed, RATING_USER_LAYOUTS).collect())
    assert got == [("R", 1, 10, 4, None), ("R", 3, 11, 5, None), ("U", 1, None, None, "M")]


def test_one_pass_averages_equal_the_join_forms(spark, lines):
    from sparkdeck.sources.delimited import RATING_USER_LAYOUTS, parse_by_content

    rating_lines = [f"{u}\t{i}\t{(u * 7 + i) % 5 + 1}\t0" for u in range(1, 40) for i in range(u % 4 + 1)]
    user_lines = [f"{u}|30|{'MF'[u % 2]}|occ|00000" for u in range(1, 35)]  # users 35-39 unknown
    mixed = lines(rating_lines + user_lines + [user_lines[0].replace("|M|", "|F|")])  # a duplicate user
    tagged = parse_by_content(mixed, RATING_USER_LAYOUTS)
    one = {r.gender: (round(r.avg_rating, 12), r.n_ratings)
           for r in ratings.group_average_one_pass(tagged, "user_id", "gender").collect()}
    r = tagged.filter("kind = 'R'").select("user_id", "item_id", "rating")
    u = tagged.filter("kind = 'U'").select("user_id", "gender")
    two = {x.gender: (round(x.avg_rating, 12), x.n_ratings)
           for x in ratings.avg_rating_by_group(r, u, "gender").collect()}
    assert one == two and set(one) == {"M", "F"}
