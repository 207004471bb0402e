"""Page source (S1), seed dimension (S2) and the seed union.

Live crawling is re-aimed at a captured page table ``(page_id, url, html)``:
a module's documents are the pages under any of its seed URLs. The prefix
match is an equi-join: each page URL is expanded to its ancestor prefixes
(bounded by path depth) and joined to the seeds on equality, so no seed x page
comparison is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Module -> seed URLs.
MODULE_URLS: dict[str, list[str]] = {
    "langgraph": [
        "https://langchain-ai.github.io/langgraph/concepts/",
        "https://langchain-ai.github.io/langgraph/how-tos/",
        "https://langchain-ai.github.io/langgraph/tutorials/workflows/",
        "https://langchain-ai.github.io/langgraph/tutorials/introduction/",
        "https://langchain-ai.github.io/langgraph/tutorials/langgraph-platform/local-server/",
        "https://python.langchain.com/docs/get_started/introduction/",
        "https://python.langchain.com/docs/modules/",
        "https://python.langchain.com/docs/use_cases/",
    ],
    "langchain": [
        "https://python.langchain.com/docs/get_started/introduction/",
        "https://python.langchain.com/docs/modules/",
        "https://python.langchain.com/docs/use_cases/",
    ],
    "dpytest": [
        "https://dpytest.readthedocs.io/en/latest/index.html",
        "https://dpytest.readthedocs.io/en/latest/tutorials/index.html",
        "https://dpytest.readthedocs.io/en/latest/modules/index.html",
        "https://dpytest.readthedocs.io/en/latest/modules/backend.html",
        "https://dpytest.readthedocs.io/en/latest/modules/callbacks.html",
        "https://dpytest.readthedocs.io/en/latest/modules/factories.html",
        "https://dpytest.readthedocs.io/en/latest/modules/runner.html",
        "https://dpytest.readthedocs.io/en/latest/modules/state.html",
        "https://dpytest.readthedocs.io/en/latest/modules/utils.html",
        "https://dpytest.readthedocs.io/en/latest/modules/verify.html",
        "https://dpytest.readthedocs.io/en/latest/modules/websocket.html",
    ],
    "discord": [
        "https://discordpy.readthedocs.io/en/stable/index.html",
        "https://discordpy.readthedocs.io/en/stable/intro.html",
        "https://discordpy.readthedocs.io/en/stable/quickstart.html",
        "https://discordpy.readthedocs.io/en/stable/logging.html",
        "https://discordpy.readthedocs.io/en/stable/discord.html",
        "https://discordpy.readthedocs.io/en/stable/intents.html",
        "https://github.com/Rapptz/discord.py/tree/v2.5.2/examples",
        "https://discordpy.readthedocs.io/en/stable/faq.html",
        "https://discordpy.readthedocs.io/en/stable/genindex.html",
    ],
}


def seed_table(spark: SparkSession, module_urls: dict[str, list[str]] = MODULE_URLS) -> DataFrame:
    """``module, seed_pos, seed_url`` rows."""
    rows = [(m, i, u) for m, urls in module_urls.items() for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "module string, seed_pos int, seed_url string")


def check_module(module: str, module_urls: dict[str, list[str]] = MODULE_URLS) -> None:
    if module not in module_urls:
        raise ValueError(f"Module '{module}' not found. Available modules: {list(module_urls.keys())}")


def url_ancestors(url) -> F.Column:
    """The URL, the URL without query/fragment, and every prefix of it that ends
    in ``/`` after the host."""
    u = F.col(url) if isinstance(url, str) else url
    base = F.regexp_replace(u, r"[?#].*$", "")
    head = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    rest = F.substring(base, F.length(head) + 1, 1 << 30)
    segs = F.split(rest, "/", -1)
    # prefixes head + "/" + seg1 + "/" ... for every complete directory level
    n_dirs = F.size(segs) - 1
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(n_dirs, F.lit(1))),
                           lambda i: F.concat(head, F.array_join(F.slice(segs, 1, i), "/"), F.lit("/")))
    prefixes = F.when(n_dirs >= 1, prefixes).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(u, base), prefixes))


def pages_for_seeds(pages: DataFrame, seeds: DataFrame, url_col: str = "url") -> DataFrame:
    """S1 + U1: one row per (seed, page under it); overlapping seeds repeat a page
    on purpose (no dedupe). ``dedupe=True`` of ``load_pages`` drops repeats."""
    anc = pages.withColumn("_anc", F.explode_outer(url_ancestors(url_col))).filter(F.col("_anc").isNotNull())
    return anc.join(seeds, F.col("_anc") == F.col("seed_url")).drop("_anc")


def load_pages(pages: DataFrame, seeds: DataFrame, module: str | None = None,
               dedupe: bool = False, known_modules: list[str] | None = None) -> DataFrame:
    if module is not None:
        if known_modules is not None and module not in known_modules:
            raise ValueError(f"Module '{module}' not found. Available modules: {known_modules}")
        seeds = seeds.filter(F.col("module") == module)
    out = pages_for_seeds(pages, seeds)
    return out.dropDuplicates(["module", "url"]) if dedupe else out
