"""Edit wars, super editors and topic trends in sliding event-time windows.

Every operator runs on static tables and on streams and returns the same columns.

On static tables a window is put together from tumbling panes as wide as the common step of
size and slide. Edits are first reduced to one row per pane and key: user, or page and user, or
topic and page. Each task does most of that before the shuffle, and a user, page or topic with a
large share of all edits is split by pane and member. Only the reduced rows are copied into the
``size / slide`` windows they belong to. Users of a page and titles of a topic are put into lists
only after the conditions on counts have been applied.

On streams the same result comes from one stateful aggregation behind a watermark; its state
per window is dropped once the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.times import duration_micros, event_micros, pane_width

SIZE, SLIDE, WATERMARK = "5 minutes", "1 minute", "5 minutes"


def _panes(
    edits: DataFrame, size: str, slide: str, time_col: str, keys: list[str], aggs: list[Column]
) -> DataFrame:
    start = F.window(time_col, pane_width(size, slide))["start"]
    # A window start is never null. Saying so saves the null filters of the windows over panes.
    epoch = F.lit("1970-01-01 00:00:00").cast(edits.schema[time_col].dataType)
    return edits.groupBy(F.coalesce(start, epoch).alias("pane"), *keys).agg(*aggs)


def in_windows(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Each pane row once per window that covers its pane, the window as two plain times: as
    grouping keys they sort and hash faster than a struct."""
    windowed = panes.withColumn("window", F.window("pane", size, slide))
    bounds = F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time")
    return windowed.select(*panes.columns, *bounds)


def _merged(members: str) -> Column:
    """The distinct members of several panes; a window has at most size / slide of them."""
    return F.array_distinct(F.flatten(F.collect_list(members)))


def _joined(members: str, separator: str) -> Column:
    return F.array_join(F.sort_array(members), separator)


def _count(members: str) -> Column:
    return F.size(members).cast("bigint")


STATIC_KEY, STREAM_KEY = ["start_time", "end_time"], ["window"]


def _flat(windowed: DataFrame, columns: list[str]) -> DataFrame:
    if "window" in windowed.columns:
        start, end = F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time")
        return windowed.select(start, end, *columns)
    return windowed.select(*STATIC_KEY, *columns)


def _window_rows(edits: DataFrame, size: str, slide: str, time_col: str, watermark: str):
    """Every edit once per window, and the window's key: the plain way, for streams and for
    counts that cannot be merged from panes."""
    if edits.isStreaming:
        late_limited = edits.withWatermark(time_col, watermark)
        return late_limited.withColumn("window", F.window(time_col, size, slide)), STREAM_KEY
    return in_windows(edits.withColumn("pane", F.col(time_col)), size, slide), STATIC_KEY


# ---- edit wars ---------------------------------------------------------------------------

WAR_COLUMNS = [
    "title", "total_edits", "unique_users", "combatants",
    "latest_comment", "latest_revision", "reverts_count",
]


def _war_facts(edits: DataFrame, time_col: str, revert_pattern: str) -> DataFrame:
    return edits.withColumns(
        {
            "is_revert": text.revert_flag("comment", revert_pattern),
            "latest": F.struct(time_col, "revision_id", "comment"),
        }
    )


def _war_counts() -> list[Column]:
    return [F.count("user").alias("edits"), F.sum("is_revert").alias("reverts")]


def _war_aggregates() -> list[Column]:
    latest, users = F.max("latest").alias("latest"), F.collect_set("user").alias("users")
    return [*_war_counts(), latest, users]


def war_panes(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    time_col: str = "ts",
    revert_pattern: str = text.REVERT_PATTERN,
) -> DataFrame:
    """Edits, reverts, latest edit and users per (pane, title)."""
    facts = _war_facts(edits, time_col, revert_pattern)
    return _panes(facts, size, slide, time_col, ["title"], _war_aggregates())


def war_totals(panes: DataFrame, by: list[str], *extra: Column) -> DataFrame:
    """War columns per (``by``, title) from pane rows."""
    return _war_columns(
        panes.groupBy(*by, "title").agg(
            F.sum("edits").alias("edits"),
            F.sum("reverts").alias("reverts"),
            F.max("latest").alias("latest"),
            _merged("users").alias("users"),
            *extra,
        )
    )


def _war_columns(wars: DataFrame, unique_users: Column | None = None, combatants: Column | None = None) -> DataFrame:
    """The latest comment and revision are those of the newest (time, revision), so they do not
    depend on arrival order."""
    return wars.withColumns(
        {
            "total_edits": F.col("edits"),
            "reverts_count": F.col("reverts"),
            "unique_users": _count("users") if unique_users is None else unique_users,
            "combatants": _joined("users", ", ") if combatants is None else combatants,
            "latest_comment": F.col("latest.comment"),
            "latest_revision": F.col("latest.revision_id"),
        }
    )


def war_condition(min_edits: int = 2, min_reverts: int = 1, min_users: int = 1) -> Column:
    # min_users = 1 asks nothing: a page whose editors are all unknown counts as well.
    condition = (F.col("total_edits") >= min_edits) & (F.col("reverts_count") >= min_reverts)
    return condition & (F.col("unique_users") >= min_users) if min_users > 1 else condition


def edit_wars(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_edits: int = 2,
    min_reverts: int = 1,
    min_users: int = 1,
    revert_pattern: str = text.REVERT_PATTERN,
    exact: bool = True,
    time_col: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Pages under conflict: per (window, title) the edits, distinct users, users joined in
    name order, latest comment and revision, and reverts; kept when edits and reverts reach
    their minimum.

    On static tables the users of a page are counted first, and listed only where the conditions
    hold. ``exact=False`` estimates the number of users from mergeable sketches, one for each
    pane, and lists nobody (``combatants`` is null).
    """
    facts = _war_facts(edits, time_col, revert_pattern)
    condition = war_condition(min_edits, min_reverts, min_users)
    latest = F.max("latest").alias("latest")
    if not exact:
        sketch = F.hll_sketch_agg("user").alias("sketch")
        if edits.isStreaming:
            rows, key = _window_rows(facts, size, slide, time_col, watermark)
            wars = rows.groupBy(*key, "title").agg(*_war_counts(), latest, sketch)
        else:
            panes = _panes(facts, size, slide, time_col, ["title"], [*_war_counts(), latest, sketch])
            key = STATIC_KEY
            wars = in_windows(panes, size, slide).groupBy(*key, "title").agg(
                F.sum("edits").alias("edits"), F.sum("reverts").alias("reverts"), latest, F.hll_union_agg("sketch").alias("sketch")
            )
        wars = _war_columns(wars, F.hll_sketch_estimate("sketch"), F.lit(None).cast("string"))
    elif edits.isStreaming:
        rows, key = _window_rows(facts, size, slide, time_col, watermark)
        wars = _war_columns(rows.groupBy(*key, "title").agg(*_war_aggregates()))
    else:
        per_user = _per_member(
            facts, size, slide, time_col, "title", "user", [*_war_counts(), latest],
            [F.sum("edits").alias("edits"), F.sum("reverts").alias("reverts"), latest],
        )
        totals = [F.sum("edits").alias("edits"), F.sum("reverts").alias("reverts"), latest, F.count("user").alias("n")]
        wars = per_user.groupBy(*STATIC_KEY, "title").agg(*totals).withColumns(
            {"total_edits": F.col("edits"), "reverts_count": F.col("reverts"), "unique_users": F.col("n")}
        )
        wars = _with_list(wars.filter(condition), per_user, "title", "user", ", ", "combatants")
        wars = _war_columns(wars, F.col("n"), F.col("combatants"))
    return _flat(wars.filter(condition), WAR_COLUMNS)


def _per_member(
    rows: DataFrame, size: str, slide: str, time_col: str, key: str, member: str, aggs: list[Column], merged: list[Column]
) -> DataFrame:
    """One row per (window, key, member): a key with a large share of the edits is spread over its
    members."""
    panes = _panes(rows, size, slide, time_col, [key, member], aggs)
    return in_windows(panes, size, slide).groupBy(*STATIC_KEY, key, member).agg(*merged)


def _with_list(found: DataFrame, members: DataFrame, key: str, member: str, separator: str, out: str) -> DataFrame:
    """``found`` with the members of each (window, key) joined in name order: only rows of
    ``members`` that belong to a found key reach a list."""
    listed = F.array_join(F.sort_array(F.collect_list(member)), separator).alias(out)
    keys = [*STATIC_KEY, key]
    same = [F.first(c).alias(c) for c in found.columns if c not in keys]
    return _with_totals(members.select(*keys, member), found, key).groupBy(*keys).agg(listed, *same)


def war_members(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_edits: int = 2,
    min_reverts: int = 1,
    min_users: int = 1,
    revert_pattern: str = text.REVERT_PATTERN,
    time_col: str = "ts",
) -> DataFrame:
    """The parties of the edit wars as rows: (window, title, user) with the user's edits and
    reverts and the totals of the war. No cell holds a list, so this is the form for pages with
    a very large number of editors in one window; the join that adds the totals is left to
    adaptive skew splitting. Reverts by unknown users are in a row without a user. Static tables
    only.
    """
    facts = _war_facts(edits, time_col, revert_pattern)
    per_user = _per_member(
        facts, size, slide, time_col, "title", "user", _war_counts(),
        [F.sum("edits").alias("user_edits"), F.sum("reverts").alias("user_reverts")],
    )
    wars = (
        per_user.groupBy(*STATIC_KEY, "title")
        .agg(
            F.sum("user_edits").alias("total_edits"),
            F.count("user").alias("unique_users"),
            F.sum("user_reverts").alias("reverts_count"),
        )
        .filter(war_condition(min_edits, min_reverts, min_users))
    )
    return _flat(
        _with_totals(per_user, wars, "title"),
        ["title", "user", "user_edits", "user_reverts", "total_edits", "unique_users", "reverts_count"],
    )


def _with_totals(members: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    # Both sides of the join are the same grouping. Null-safe keys keep Spark from adding
    # different null filters to the two, so that it computes the grouping once.
    keys = [*STATIC_KEY, key]
    total = totals.withColumnsRenamed({k: f"_{k}" for k in keys})
    return members.join(total, [members[k].eqNullSafe(total[f"_{k}"]) for k in keys])


# ---- super editors -----------------------------------------------------------------------

EDITOR_COLUMNS = [
    "user", "edit_count", "is_bot_flag", "is_suspicious_flag", "avg_length_diff", "langs_edited",
]


def _editor_aggregates(time_col: str) -> list[Column]:
    return [
        F.count("*").alias("edits"),
        F.sum("length_diff").alias("length_sum"),
        F.max(F.struct(time_col, "revision_id", "is_bot", "is_suspicious")).alias("latest"),
        F.collect_set("wiki_lang").alias("langs"),
    ]


def editor_panes(
    edits: DataFrame, size: str = SIZE, slide: str = SLIDE, time_col: str = "ts"
) -> DataFrame:
    """Edits, summed length change, latest flags and languages per (pane, user)."""
    return _panes(edits, size, slide, time_col, ["user"], _editor_aggregates(time_col))


def busy_editors(panes: DataFrame, size: str, min_edits: int) -> DataFrame:
    """Without the panes that cannot be in any window of ``min_edits`` edits: all windows over a
    pane lie within ``size`` of it on either side, so their edits are at most the user's edits
    in that stretch. Most users edit once or twice, and their rows need not be copied into
    windows at all. A user has one row per pane here, whatever the number of edits.
    """
    reach = duration_micros(size)
    near = (
        Window.partitionBy("user")
        .orderBy(event_micros(panes, "pane"))
        .rangeBetween(-reach, reach)
    )
    return panes.withColumn("near", F.sum("edits").over(near)).filter(F.col("near") >= min_edits).drop("near")


def editor_totals(panes: DataFrame, by: list[str], *extra: Column) -> DataFrame:
    """Editor columns per (``by``, user) from pane rows."""
    return _editor_columns(
        panes.groupBy(*by, "user").agg(
            F.sum("edits").alias("edits"),
            F.sum("length_sum").alias("length_sum"),
            F.max("latest").alias("latest"),
            _merged("langs").alias("langs"),
            *extra,
        )
    )


def _editor_columns(editors: DataFrame) -> DataFrame:
    """The mean divides by all edits, also those without a length."""
    return editors.withColumns(
        {
            "edit_count": F.col("edits"),
            "is_bot_flag": F.col("latest.is_bot"),
            "is_suspicious_flag": F.col("latest.is_suspicious"),
            "avg_length_diff": F.col("length_sum") / F.col("edits"),
            "langs_edited": _joined("langs", ", "),
        }
    )


def super_editors(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_edits: int = 3,
    time_col: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Very active users: per (window, user) the edits, latest flags, mean length change and
    languages joined in name order; kept from ``min_edits`` edits on."""
    if edits.isStreaming:
        rows, key = _window_rows(edits, size, slide, time_col, watermark)
        editors = _editor_columns(rows.groupBy(*key, "user").agg(*_editor_aggregates(time_col)))
    else:
        panes = busy_editors(editor_panes(edits, size, slide, time_col), size, min_edits)
        editors = editor_totals(in_windows(panes, size, slide), STATIC_KEY)
    return _flat(editors.filter(F.col("edit_count") >= min_edits), EDITOR_COLUMNS)


# ---- topic trends ------------------------------------------------------------------------

TOPIC_COLUMNS = ["topic", "article_count", "total_edits", "sample_titles"]


def _topic_aggregates() -> list[Column]:
    return [F.count("*").alias("edits"), F.collect_set("title").alias("titles")]


def topic_panes(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    time_col: str = "ts",
    separators: str = "[ _]",
) -> DataFrame:
    """Edits and titles per (pane, topic)."""
    topics = edits.withColumn("topic", text.topic_key("title", separators))
    return _panes(topics, size, slide, time_col, ["topic"], _topic_aggregates())


def topic_totals(panes: DataFrame, by: list[str], *extra: Column) -> DataFrame:
    """Topic columns per (``by``, topic) from pane rows."""
    return _topic_columns(
        panes.groupBy(*by, "topic").agg(
            F.sum("edits").alias("edits"), _merged("titles").alias("titles"), *extra
        )
    )


def _topic_columns(
    topics: DataFrame, article_count: Column | None = None, sample_titles: Column | None = None
) -> DataFrame:
    return topics.withColumns(
        {
            "total_edits": F.col("edits"),
            "article_count": _count("titles") if article_count is None else article_count,
            "sample_titles": _joined("titles", " | ") if sample_titles is None else sample_titles,
        }
    )


def topic_trends(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_articles: int = 2,
    separators: str = "[ _]",
    exact: bool = True,
    time_col: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Topics (first title word) spread over several pages: per (window, topic) the distinct
    titles, edits, and titles joined in name order; kept from ``min_articles`` titles on.

    On static tables the titles of a topic are counted first, and listed only where there are
    enough. ``exact=False`` estimates their number from mergeable sketches, one for each pane,
    and lists none (``sample_titles`` is null)."""
    topics = edits.withColumn("topic", text.topic_key("title", separators))
    enough = F.col("article_count") >= min_articles
    edits_sum = F.sum("edits").alias("edits")
    if not exact:
        aggs = [F.count("*").alias("edits"), F.hll_sketch_agg("title").alias("sketch")]
        if edits.isStreaming:
            rows, key = _window_rows(topics, size, slide, time_col, watermark)
            topics = rows.groupBy(*key, "topic").agg(*aggs)
        else:
            panes = _panes(topics, size, slide, time_col, ["topic"], aggs)
            topics = in_windows(panes, size, slide).groupBy(*STATIC_KEY, "topic").agg(
                edits_sum, F.hll_union_agg("sketch").alias("sketch")
            )
        topics = _topic_columns(topics, F.hll_sketch_estimate("sketch"), F.lit(None).cast("string"))
    elif edits.isStreaming:
        rows, key = _window_rows(topics, size, slide, time_col, watermark)
        topics = _topic_columns(rows.groupBy(*key, "topic").agg(*_topic_aggregates()))
    else:
        per_title = _per_member(
            topics, size, slide, time_col, "topic", "title", [F.count("*").alias("edits")], [edits_sum]
        )
        found = per_title.groupBy(*STATIC_KEY, "topic").agg(edits_sum, F.count("title").alias("article_count"))
        listed = _with_list(found.filter(enough), per_title, "topic", "title", " | ", "sample_titles")
        topics = _topic_columns(listed, F.col("article_count"), F.col("sample_titles"))
    return _flat(topics.filter(enough), TOPIC_COLUMNS)


def topic_members(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_articles: int = 2,
    separators: str = "[ _]",
    time_col: str = "ts",
) -> DataFrame:
    """The pages of the trending topics as rows: (window, topic, title) with the page's edits and
    the totals of the topic. No cell holds a list, so this is the form for first words that very
    many titles share. Static tables only."""
    topics = edits.withColumn("topic", text.topic_key("title", separators))
    per_title = _per_member(
        topics, size, slide, time_col, "topic", "title", [F.count("*").alias("edits")],
        [F.sum("edits").alias("title_edits")],
    )
    found = (
        per_title.groupBy(*STATIC_KEY, "topic")
        .agg(F.sum("title_edits").alias("total_edits"), F.count("title").alias("article_count"))
        .filter(F.col("article_count") >= min_articles)
    )
    return _flat(_with_totals(per_title, found, "topic"), ["topic", "title", "title_edits", "article_count", "total_edits"])


# ---- rankings ----------------------------------------------------------------------------


def wars_by_edits(wars: DataFrame) -> DataFrame:
    """Wars with most edits first. A report order; stored tables do not need it."""
    return wars.orderBy(F.desc("total_edits"), "start_time", "title")


def top_editors_of_batch(editors: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` rows with most edits over all windows together."""
    return editors.orderBy(F.desc("edit_count"), "start_time", "user").limit(k)


def top_editors_per_window(editors: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` rows with most edits of each window, with their place."""
    order = Window.partitionBy("start_time").orderBy(F.desc("edit_count"), "user")
    return editors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_topics_of_batch(topics: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows with most edits over all windows together."""
    return topics.orderBy(F.desc("total_edits"), "start_time", "topic").limit(k)
