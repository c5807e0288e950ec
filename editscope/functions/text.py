"""Column expressions over titles, comments, flags and server names (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact words.
REVERT_PATTERN = "revert|undid|undo|wycofano|przywrócono|revertido"
EXCLUDED_TITLE_PREFIXES = ("Category:", "Talk:")
UNKNOWN_LANG = "??"
SUSPECTED_BOT, BOT, HUMAN = "SUSPECTED_BOT", "BOT", "HUMAN"
CATEGORY_PAGE, TALK_PAGE, ARTICLE_PAGE = "KATEGORIA", "DYSKUSJA", "ARTYKUŁ"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SITE = "https://en.wikipedia.org"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wiki_lang(server_name: Column | str) -> Column:
    """Host text before the first dot; hosts without a dot, and null, give ``??``."""
    host = _col(server_name)
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", 1)).otherwise(UNKNOWN_LANG)


def topic_key(title: Column | str, separators: str = "[ _]") -> Column:
    """First word of the title; a leading separator or an empty title gives ``''``."""
    return F.split(_col(title), separators, 2)[0]


def is_content_title(title: Column | str) -> Column:
    """False for category and talk pages. Null stays null, so a filter drops it."""
    category, talk = EXCLUDED_TITLE_PREFIXES
    return ~_col(title).startswith(category) & ~_col(title).startswith(talk)


def page_category(title: Column | str) -> Column:
    category, talk = EXCLUDED_TITLE_PREFIXES
    return (
        F.when(_col(title).startswith(category), CATEGORY_PAGE)
        .when(_col(title).startswith(talk), TALK_PAGE)
        .otherwise(ARTICLE_PAGE)
    )


def revert_flag(comment: Column | str, pattern: str = REVERT_PATTERN) -> Column:
    """1 when the lower-cased comment matches ``pattern``, else 0 (also for null)."""
    return F.when(F.lower(_col(comment)).rlike(pattern), 1).otherwise(0)


def editor_type(is_suspicious: Column | str, is_bot: Column | str) -> Column:
    """Suspected bot before known bot before human; a null flag falls through."""
    return (
        F.when(_col(is_suspicious), SUSPECTED_BOT).when(_col(is_bot), BOT).otherwise(HUMAN)
    )


def editor_type_v1(is_bot: Column | str) -> Column:
    """The two-way class of the older event layout."""
    return F.when(_col(is_bot), BOT).otherwise(HUMAN)


def page_url(title: Column | str, site: Column | str = SITE) -> Column:
    """Article address. ``site`` may be a column, see ``site_of``."""
    base = F.lit(site) if isinstance(site, str) else site
    return F.concat(base, F.lit("/wiki/"), F.replace(_col(title), F.lit(" "), F.lit("_")))


def diff_url(revision_id: Column | str, site: Column | str = SITE) -> Column:
    """Two-column comparison address; null when the revision is unknown."""
    base = F.lit(site) if isinstance(site, str) else site
    return F.concat(base, F.lit("/w/index.php?diff="), _col(revision_id).cast("string"))


def site_of(lang: Column | str, default: str = SITE) -> Column:
    """Site address of a language edition, for callers whose rows keep their language."""
    known = _col(lang).isNotNull() & (_col(lang) != UNKNOWN_LANG)
    return F.when(known, F.format_string("https://%s.wikipedia.org", _col(lang))).otherwise(default)
