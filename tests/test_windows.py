import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from editscope.operators import windows

from .edits import T0, at, edit, random_edits, table

MIN = dt.timedelta(minutes=1)


def starts(ts, size, slide):
    """Starts of the sliding windows that hold ``ts``."""
    epoch = dt.datetime(1970, 1, 1)
    last = epoch + ((ts - epoch) // slide) * slide
    out = []
    while last + size > ts:
        out.append(last)
        last -= slide
    return out


def brute_force(rows, key, size, slide):
    groups = defaultdict(list)
    for r in rows:
        for s in starts(r[1], size, slide):
            groups[s, key(r)].append(r)
    return groups


def is_revert(comment):
    return any(w in (comment or "").lower() for w in ("revert", "undid", "undo"))


SHAPES = [("5 minutes", "1 minute"), ("7 minutes", "2 minutes"), ("5 minutes", "5 minutes"), ("90 seconds", "1 minute")]


def delta(text):
    number, unit = text.split()
    return dt.timedelta(**{unit if unit.endswith("s") else unit + "s": int(number)})


@pytest.mark.parametrize("size,slide", SHAPES)
def test_edit_wars_like_brute_force(spark, size, slide):
    rows = random_edits(1)
    expected = set()
    for (start, title), g in brute_force(rows, lambda r: r[5], delta(size), delta(slide)).items():
        users = sorted({r[2] for r in g if r[2] is not None})
        total, reverts = sum(r[2] is not None for r in g), sum(is_revert(r[8]) for r in g)
        newest = max(g, key=lambda r: (r[1], r[9]))
        if total >= 2 and reverts >= 1:
            expected.add((start, start + delta(size), title, total, len(users), ", ".join(users),
                          newest[8], newest[9], reverts))
    got = windows.edit_wars(table(spark, rows), size, slide)
    assert {tuple(r) for r in got.collect()} == expected and expected


@pytest.mark.parametrize("size,slide", SHAPES)
def test_super_editors_like_brute_force(spark, size, slide):
    rows = random_edits(2)
    expected = set()
    for (start, user), g in brute_force(rows, lambda r: r[2], delta(size), delta(slide)).items():
        newest = max(g, key=lambda r: (r[1], r[9]))
        lengths = [r[7] for r in g if r[7] is not None]
        if len(g) >= 3:
            expected.add((start, start + delta(size), user, len(g), newest[3], newest[4],
                          sum(lengths) / len(g) if lengths else None,
                          ", ".join(sorted({r[6] for r in g if r[6]}))))
    got = windows.super_editors(table(spark, rows), size, slide)
    assert {tuple(r) for r in got.collect()} == expected and expected


@pytest.mark.parametrize("size,slide", SHAPES)
def test_topic_trends_like_brute_force(spark, size, slide):
    rows = random_edits(3)
    expected = set()
    topic = lambda r: r[5].replace("_", " ").split(" ")[0]
    for (start, name), g in brute_force(rows, topic, delta(size), delta(slide)).items():
        titles = sorted({r[5] for r in g})
        if len(titles) >= 2:
            expected.add((start, start + delta(size), name, len(titles), len(g), " | ".join(titles)))
    got = windows.topic_trends(table(spark, rows), size, slide)
    assert {tuple(r) for r in got.collect()} == expected and expected


def test_event_lies_in_five_windows(spark):
    rows = [edit(1, 256, comment="undo"), edit(2, 256, user="v")]
    got = sorted(r.start_time for r in windows.edit_wars(table(spark, rows)).collect())
    assert got == [T0 + i * MIN for i in range(5)]


def test_window_edge_and_null_time(spark):
    rows = [edit(1, 0, comment="undo"), edit(2, 300), edit(3, ts=None), edit(4, ts=None, comment="undo")]
    assert windows.edit_wars(table(spark, rows)).count() == 0


def war(spark, *rows, **options):
    return windows.edit_wars(table(spark, rows), "5 minutes", "5 minutes", **options).collect()


def test_war_conditions(spark):
    revert, plain = edit(1, comment="Undid"), edit(2, 1)
    assert len(war(spark, revert, plain)) == 1
    assert war(spark, edit(1), plain) == []
    assert war(spark, revert) == []
    assert war(spark, revert, edit(2, 1, user=None)) == []
    assert war(spark, revert, plain, min_users=2) == []
    assert len(war(spark, revert, edit(2, 1, user="v"), min_users=2)) == 1
    assert war(spark, revert, plain, min_edits=3) == []
    assert len(war(spark, edit(1, comment="anulada"), plain, revert_pattern="anulad")) == 1


def test_latest_comment_may_be_null_and_ties_go_by_revision(spark):
    row = war(spark, edit(1, 5, comment="undo"), edit(9, 5, comment=None), edit(3, 4))[0]
    assert (row.latest_comment, row.latest_revision) == (None, 9)


def test_missing_lengths_count_in_the_mean(spark):
    rows = [edit(1, length_diff=10), edit(2, 1, length_diff=None), edit(3, 2, length_diff=5)]
    assert windows.super_editors(table(spark, rows), "5 minutes", "5 minutes").first().avg_length_diff == 5.0


def test_approximate_users_are_close(spark):
    rows = [edit(i, i % 60, user=f"u{i}", comment="undo") for i in range(500)]
    got = war(spark, *rows, exact=False)[0]
    assert got.total_edits == 500 and abs(got.unique_users - 500) <= 75
    assert war(spark, *rows)[0].unique_users == 500


def test_members_agree_with_wars(spark):
    rows = table(spark, random_edits(4))
    joined = (
        windows.war_members(rows)
        .groupBy("start_time", "title", "total_edits", "unique_users", "reverts_count")
        .agg(F.array_join(F.array_sort(F.collect_list("user")), ", ").alias("combatants"))
    )
    key = ["start_time", "title", "total_edits", "unique_users", "reverts_count", "combatants"]
    wars = windows.edit_wars(rows).filter("unique_users > 0").select(key)
    assert sorted(map(tuple, joined.select(key).collect())) == sorted(map(tuple, wars.collect()))


def test_rankings(spark):
    rows = [edit(100 * u + i, 60 * w, user=f"u{u}") for u in range(4) for w in range(2) for i in range(3 + u)]
    editors = windows.super_editors(table(spark, rows), "1 minute", "1 minute")
    assert [r.user for r in windows.top_editors_of_batch(editors, 3).collect()] == ["u3", "u3", "u2"]
    per_window = windows.top_editors_per_window(editors, 1).collect()
    assert sorted((r.start_time, r.user, r.place) for r in per_window) == [(at(0), "u3", 1), (at(60), "u3", 1)]


def test_wars_come_ordered_for_reports(spark):
    wars = windows.wars_by_edits(windows.edit_wars(table(spark, random_edits(5)))).collect()
    counts = [r.total_edits for r in wars]
    assert counts == sorted(counts, reverse=True)


def test_repeated_edits_shrink_before_they_are_copied_into_windows(spark):
    rows = table(spark, [edit(i, 10, comment="undo") for i in range(50)])
    panes = windows.war_panes(rows)
    assert panes.count() == 1 and windows.in_windows(panes, "5 minutes", "1 minute").count() == 5


def test_result_invariants(spark):
    rows = table(spark, random_edits(6))
    wars = windows.edit_wars(rows)
    bad = wars.filter(
        "total_edits < 2 or reverts_count < 1 or unique_users > total_edits "
        "or end_time - start_time <> interval 5 minutes or second(start_time) <> 0"
    )
    assert bad.count() == 0
    topics = windows.topic_trends(rows)
    assert topics.filter("article_count <> size(split(sample_titles, ' [|] '))").count() == 0
