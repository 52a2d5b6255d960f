"""Page links followed: which landed pages a series' chain reaches, in which order, and where it breaks off.

Every page names its own address and that of the next page. All chains are followed at once by pointer jumping: in
every round a page learns what lies twice as far ahead, so a chain of a million pages takes twenty rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.operators.positions import null_safe_join
from hydroflow.session import stored


def _jumped(ahead: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pages with what lies as far again behind the page that they see."""
    seen = ahead.withColumnsRenamed({"page": "_page", "to": "_to"})
    met = null_safe_join(ahead, seen, keys, "left", F.col("to") == F.col("_page"))
    return met.select(*keys, "page", F.col("_to").alias("to"))


def follow_links(pages: DataFrame, keys: Sequence[str], page: str, link: str, is_first: Column) -> DataFrame:
    """``(keys, page, at)``: the pages that can be reached from a first page, and how many links behind it they are.

    ``pages`` has the address of each page and the one it links to (NULL at the end of a chain). A page that is landed
    twice counts once, the smallest of its links holds. Several first pages of one series start at 0 each; a page that can
    be reached on two ways has the shorter one. Loops end: no chain is longer than its series has pages. NULL keys
    are a series like any other.
    """
    keys = list(keys)
    named = pages.select(*keys, F.col(page).alias("page"), F.col(link).alias("to"), is_first.alias("first")).filter("page is not null")
    once = stored(named.groupBy(*keys, "page").agg(F.min("to").alias("to"), F.max("first").alias("first")), "chain-pages")
    longest = once.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    reached = stored(once.filter("first").select(*keys, "page", F.lit(0).cast("long").alias("at")), "chain-reached")
    # A link to a page that was not landed leads nowhere.
    here = once.select(*keys, F.col("page").alias("_there"))
    ahead = stored(null_safe_join(once.filter("to is not null"), here, keys, also=F.col("to") == F.col("_there")).select(*keys, "page", "to"), "chain-links")
    step = 1
    while step <= longest and not ahead.isEmpty():
        further = null_safe_join(reached, ahead, [*keys, "page"])
        further = further.select(*keys, F.col("to").alias("page"), (F.col("at") + step).alias("at"))
        reached = stored(reached.unionByName(further).groupBy(*keys, "page").agg(F.min("at").alias("at")), "chain-reached")
        ahead = stored(_jumped(ahead, keys).filter("to is not null"), "chain-links")
        step *= 2
    return reached


def chain_report(pages: DataFrame, keys: Sequence[str], page: str, link: str, is_first: Column, rows: Column) -> DataFrame:
    """One row per series: ``status``, ``n_pages``, ``n_rows`` of its chain, ``missing`` and ``n_orphans``.

    ``complete``: the chain from a first page ends at a page without a link. ``broken``: it links to a page that was not
    landed, named in ``missing``. ``loop``: it leads back into itself. ``no_first``: there is no first page. Orphans are
    landed pages that no chain reaches, for instance those behind a page that is missing; ``rows`` is the number of rows of
    a page, a page that is landed twice counts once.
    """
    keys = list(keys)
    named = pages.select(*keys, F.col(page).alias("page"), F.col(link).alias("to"), rows.cast("long").alias("rows"))
    once = named.filter("page is not null").groupBy(*keys, "page").agg(F.min("to").alias("to"), F.max("rows").alias("rows"))
    reached = follow_links(pages, keys, page, link, is_first)
    held = null_safe_join(once, reached, [*keys, "page"], "left")
    there = once.select(*keys, F.col("page").alias("_there"))
    held = null_safe_join(held, there, keys, "left", F.col("to") == F.col("_there"))
    on_chain, lost = F.col("at").isNotNull(), F.col("to").isNotNull() & F.col("_there").isNull()
    whole = held.groupBy(*keys).agg(
        F.count(F.when(on_chain, 1)).alias("n_pages"),
        F.coalesce(F.sum(F.when(on_chain, F.col("rows"))), F.lit(0)).alias("n_rows"),
        F.min(F.when(on_chain & lost, F.col("to"))).alias("missing"),
        F.count(F.when(~on_chain, 1)).alias("n_orphans"),
        F.count(F.when(on_chain & F.col("to").isNull(), 1)).alias("_ends"),
    )
    status = (
        F.when(F.col("n_pages") == 0, "no_first").when(F.col("missing").isNotNull(), "broken").when(F.col("_ends") == 0, "loop").otherwise("complete")
    )
    return whole.select(*keys, status.alias("status"), "n_pages", "n_rows", "missing", "n_orphans")
