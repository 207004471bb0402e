"""Change logs: commit parsing and entries (S13, F16, F17, P6, J3, A7), the
changelog line model (F22, W5, W7, J4/U2, L2), versions and links (F24, W4,
J10, F34, L3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quill.functions.text import py_strip
from quill.operators.scan import BEFORE, LAST, carry_forward, ordered_scan, previous_in_order

# Commit type -> section, excluded types, version prefix,
# section names and order, and the line patterns. The repository URL of the
# links is configuration: pass ``repo_url``; the default is a placeholder.
COMMIT_TYPES = {
    "feat": "Added", "fix": "Fixed", "perf": "Changed", "docs": "Changed", "style": "Changed",
    "refactor": "Changed", "build": "Changed", "ci": "Changed", "chore": "Added", "test": None,
    "deprecate": "Deprecated", "remove": "Removed", "security": "Security",
}
EXCLUDE_TYPES = ["test", "ci"]
VERSION_PREFIX = "v"
REPO_URL = "https://example.com/project"
SECTIONS = ["Added", "Changed", "Deprecated", "Removed", "Fixed", "Security"]
COMMIT_RE = r"(?i)^([a-z]+)(?:\(([a-z0-9/-]+)\))?: (.+)$"
BREAKING_RE = r"(?i)BREAKING CHANGE:"
VERSION_RE = r"^## \[([^\]]+)\](?: - (\d{4}-\d{2}-\d{2}))?"
LINK_RE = r"^\[([^\]]+)\]: (.+)$"
SECTION_RE = r"^### (Added|Changed|Deprecated|Removed|Fixed|Security)"
ENTRY_RE = r"^- (.+)$"
COMPONENT_MAX = 30


# ---------------------------------------------------------------- commits

def select_commits(commits: DataFrame, main_commits: DataFrame | None = None, since: str | None = None,
                   until: str | None = None, hash_col: str = "commit", date_col: str = "date",
                   merge_col: str | None = "is_merge") -> DataFrame:
    """No merges, date range, branch minus main (``left_anti`` on hash)."""
    c = commits
    if merge_col:
        c = c.filter(~F.col(merge_col))
    # bounds take the column's own timestamp type (with or without zone)
    dtype = c.schema[date_col].dataType
    if since:
        c = c.filter(F.col(date_col) >= F.lit(since).cast(dtype))
    if until:
        c = c.filter(F.col(date_col) <= F.lit(until).cast(dtype))
    if main_commits is not None:
        c = c.join(main_commits.select(hash_col), hash_col, "left_anti")
    return c


def py_title(s: Column) -> Column:
    """Python ``str.title``: a letter is upper-cased after a non-letter and
    lower-cased after a letter (Spark's ``initcap`` only looks at spaces)."""
    chars = F.split(s, "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(
        (i == 0) | ~F.element_at(chars, F.greatest(i, F.lit(1))).rlike(r"^\p{L}$"), F.upper(c)).otherwise(F.lower(c))), "")


def parse_commits(commits: DataFrame, header_col: str = "header", body_col: str = "body",
                  types: list[str] | None = None) -> DataFrame:
    """F16 + P6 + J3 + F17: commits -> ``section, entry, is_breaking``; commits
    that do not parse, excluded types and types without a section are dropped.
    ``types`` keeps only those types and clears the exclusions."""
    h = F.col(header_col)
    ok = h.rlike(COMMIT_RE)
    ctype = F.lower(F.regexp_extract(h, COMMIT_RE, 1))
    scope = F.nullif(F.regexp_extract(h, COMMIT_RE, 2), F.lit(""))
    subject = F.regexp_extract(h, COMMIT_RE, 3)
    p = commits.filter(ok).select("*", ctype.alias("ctype"), scope.alias("scope"), subject.alias("subject"))
    mapping = {t: s for t, s in COMMIT_TYPES.items() if types is None or t in types}
    excluded = [] if types is not None else EXCLUDE_TYPES
    spark = commits.sparkSession
    sec = spark.createDataFrame([(t, s) for t, s in mapping.items() if s is not None and t not in excluded],
                                "ctype string, section string")
    # The type table has at most thirteen rows.
    p = p.join(F.broadcast(sec), "ctype", "inner")
    before = py_strip(F.split_part(F.col("subject"), F.lit(":"), F.lit(1)))
    component = (F.when(F.col("scope").isNotNull(), py_title(F.col("scope")))
                 .when(F.col("subject").contains(":") & (F.length(before) < COMPONENT_MAX), py_title(before)))
    breaking = F.coalesce(F.col(body_col).rlike(BREAKING_RE), F.lit(False))
    entry = F.when(F.coalesce(component, F.lit("")) != "",
                   F.concat(F.lit("**"), component, F.lit("**: "), F.col("subject"))).otherwise(F.col("subject"))
    entry = F.when(breaking, F.concat(entry, F.lit(" [BREAKING]"))).otherwise(entry)
    return p.withColumn("entry", entry).withColumn("is_breaking", breaking)


def section_summary(entries: DataFrame) -> DataFrame:
    """Entries per section, any breaking change; plus the total (section null)."""
    return entries.rollup("section").agg(F.count(F.lit(1)).alias("n_entries"),
                                         F.bool_or("is_breaking").alias("any_breaking"))


# ---------------------------------------------------------------- changelog lines

def classify_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """line kind and extracted parts (version/date, section, link, entry)."""
    l = F.col(line_col)
    kind = (F.when(l.rlike(VERSION_RE), "version").when(l.rlike(SECTION_RE), "section")
            .when(l.rlike(LINK_RE), "link").when(l.rlike(ENTRY_RE), "entry").otherwise("other"))
    ext = lambda p, i: F.nullif(F.regexp_extract(l, p, i), F.lit(""))
    return lines.select("*", kind.alias("kind"),
                        F.when(kind == "version", ext(VERSION_RE, 1)).alias("version"),
                        F.when(kind == "version", ext(VERSION_RE, 2)).alias("date"),
                        F.when(kind == "section", ext(SECTION_RE, 1)).alias("section"),
                        F.when(l.rlike(LINK_RE), ext(LINK_RE, 1)).alias("link_version"),
                        F.when(l.rlike(LINK_RE), ext(LINK_RE, 2)).alias("url"))


def unreleased_entries(lines: DataFrame, file_col: str = "file", line_no_col: str = "line_no",
                       line_col: str = "line", legacy: bool = True) -> DataFrame:
    """The entries of the Unreleased block of every file, with their section.

    The current version, the Unreleased flag and the current section are
    carried forward over the lines. ``legacy=True`` keeps the reference's
    behaviour, where the Unreleased flag is never cleared, so entries under
    later versions are collected too."""
    c = classify_lines(lines, line_col)
    is_v = F.col("kind") == "version"
    unrel = (F.when(is_v & (F.col("version") == "Unreleased"), F.lit(True)) if legacy
             else F.when(is_v, F.col("version") == "Unreleased"))
    c = c.withColumn("_u", unrel).withColumn("_sec", _section_state())
    e = _open_entries(carry_forward(c, file_col, line_no_col, ["_u", "_sec"]), "_u_ff", "_sec_ff")
    return e.select(file_col, line_no_col, F.col("_sec_ff").alias("section"), F.col(line_col).alias("entry"))


def _section_state() -> Column:
    """What a line makes the current section: a version ends it."""
    return F.when(F.col("kind") == "version", F.lit("")).when(F.col("kind") == "section", F.col("section"))


def _open_entries(scanned: DataFrame, flag: str, section: str) -> DataFrame:
    """Entry lines under a section while the Unreleased flag is set."""
    return scanned.filter((F.col("kind") == "entry") & F.coalesce(F.col(flag), F.lit(False)) & (F.coalesce(F.col(section), F.lit("")) != ""))


def header_lines(lines: DataFrame, file_col: str = "file", line_no_col: str = "line_no",
                 line_col: str = "line") -> DataFrame:
    """Lines before a file's first version header, link lines excluded."""
    c = classify_lines(lines, line_col)
    first_v = c.filter(F.col("kind") == "version").groupBy(file_col).agg(F.min(line_no_col).alias("_fv"))
    j = c.join(first_v, file_col, "left")
    return j.filter((F.col("_fv").isNull() | (F.col(line_no_col) < F.col("_fv"))) & (F.col("kind") != "link")) \
        .select(file_col, line_no_col, line_col)


def section_order(lines: DataFrame, file_col: str = "file", line_no_col: str = "line_no",
                  line_col: str = "line") -> DataFrame:
    """Per file, the order of the sections present in the first Unreleased
    block (first appearance), else the fixed order. Returns ``file, section, pos``."""
    c = classify_lines(lines, line_col)
    vs = c.filter(F.col("kind") == "version")
    unrel = vs.filter(F.col(line_col).contains("[Unreleased]")).groupBy(file_col).agg(F.min(line_no_col).alias("_s"))
    # only a released version ends the block; a second Unreleased heading goes on with it
    nxt = (vs.filter(~F.col(line_col).contains("[Unreleased]")).join(unrel, file_col).filter(F.col(line_no_col) > F.col("_s"))
           .groupBy(file_col).agg(F.min(line_no_col).alias("_e")))
    blocks = lines.select(file_col).distinct().join(unrel.join(nxt, file_col, "left"), file_col, "left")
    return _order_of_sections(c.filter(F.col("kind") == "section"), blocks, file_col, line_no_col)


def _order_of_sections(sections: DataFrame, blocks: DataFrame, file_col: str, line_no_col: str) -> DataFrame:
    """W7 from the section lines and every file's Unreleased block (``_s`` to ``_e``)."""
    secs = (sections.join(blocks.select(file_col, "_s", "_e"), file_col)
            .filter((F.col(line_no_col) > F.col("_s")) & (F.col("_e").isNull() | (F.col(line_no_col) < F.col("_e"))))
            .groupBy(file_col, "section").agg(F.min(line_no_col).alias("_first")))
    # at most six sections per file: a per-file window over them is small
    found = secs.select(file_col, "section",
                        F.dense_rank().over(Window.partitionBy(file_col).orderBy("_first")).alias("pos"))
    without = blocks.select(file_col).join(found.select(file_col).distinct(), file_col, "left_anti")
    # the fixed order, generated per file (no join)
    fixed = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(i + 1).alias("pos")) for i, s in enumerate(SECTIONS)])
    return found.unionByName(without.select(file_col, F.inline(fixed)))


def merge_entries(existing: DataFrame, new: DataFrame, keys: list[str] = ["file", "section", "entry"]) -> DataFrame:
    """J4 + U2: existing entries plus new ones not already present. Duplicates
    among the new entries survive (the existing set is fixed beforehand)."""
    add = new.join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(add, allowMissingColumns=True)


def sort_entries(entries: DataFrame, group_cols: list[str], pos_col: str) -> DataFrame:
    """L2: case-insensitive order within a section, stable (ties keep input order)."""
    return entries.orderBy(*group_cols, F.lower("entry"), pos_col)


# ---------------------------------------------------------------- versions

VERSION_PARSE = r"(?i)^(\d+)\.(\d+)\.(\d+)(\.[a-z]+)?(\d+)?$"


def _digits(d: Column) -> Column:
    """A run of digits as the number is written: no leading zeros."""
    return F.regexp_replace(d, r"^0+(?=\d)", "")


def _plus_one(d: Column) -> Column:
    """The number after a run of digits, of any length."""
    nines = F.regexp_extract(d, "9*$", 0)
    rest = F.substring(d, F.lit(1), F.length(d) - F.length(nines))
    last = F.right(rest, F.lit(1)).try_cast("int") + 1
    head = F.substring(rest, F.lit(1), F.length(rest) - 1)
    return F.concat(F.when(rest == "", F.lit("1")).otherwise(F.concat(head, last.cast("string"))), F.translate(nines, "9", "0"))


def parse_version(v: Column) -> Column:
    """struct(major, minor, patch, tag, num, key). Numbers are digits of any length
    without leading zeros; ``num`` is the pre-release number ("0" when absent), null
    without a tag. ``key`` sorts as text in the order of the versions: every number
    after its length, and a release after its pre-releases. Invalid versions give null."""
    ok = v.rlike(VERSION_PARSE)
    g = lambda i: F.regexp_extract(v, VERSION_PARSE, i)
    major, minor, patch = (_digits(g(i)) for i in (1, 2, 3))
    tag = F.nullif(g(4), F.lit(""))
    num = F.coalesce(_digits(F.nullif(g(5), F.lit(""))), F.lit("0"))
    sized = lambda d: F.concat(F.lpad(F.length(d).cast("string"), 6, "0"), F.lit(":"), d)
    key = F.concat_ws(".", sized(major), sized(minor), sized(patch),
                      F.when(tag.isNotNull(), F.concat(F.lit("p"), sized(num))).otherwise(F.lit("r")))
    return F.when(ok, F.struct(major.alias("major"), minor.alias("minor"), patch.alias("patch"), tag.alias("tag"),
                               F.when(tag.isNotNull(), num).alias("num"), key.alias("key")))


def version_key(v: Column) -> Column:
    return parse_version(v)["key"]


def bump_version(v: Column) -> Column:
    """pre-release number + 1, else patch + 1 and ``.dev0``; numbers of any size."""
    p = parse_version(v)
    base = F.concat_ws(".", p["major"], p["minor"])
    return F.when(p.isNull(), F.lit(None).cast("string")).when(
        p["tag"].isNotNull(), F.concat(base, F.lit("."), p["patch"], p["tag"], _plus_one(p["num"]))
    ).otherwise(F.concat(base, F.lit("."), _plus_one(p["patch"]), F.lit(".dev0")))


def previous_versions(versions: DataFrame, file_col: str = "file", version_col: str = "version",
                      lexical: bool = False) -> DataFrame:
    """The previous version of each version of a file, by numeric order
    (``lexical=True``: by string order, as the reference sorts)."""
    v = versions.filter(F.col(version_col) != "Unreleased")
    if lexical:
        return previous_in_order(v, file_col, [version_col], version_col, "previous")
    v = v.withColumn("_k", version_key(F.col(version_col)))
    return previous_in_order(v, file_col, ["_k", version_col], version_col, "previous").drop("_k")


def release_links(new_version: Column, prev_version: Column, repo_url: str = REPO_URL,
                  prefix: str = VERSION_PREFIX) -> tuple[Column, Column]:
    """F34 + J10: the Unreleased compare link and the new version's link
    (compare to the previous version, or a release tag for the first one)."""
    unrel = F.concat(F.lit(f"{repo_url}/compare/{prefix}"), new_version, F.lit("...HEAD"))
    new = F.when(prev_version.isNotNull(), F.concat(
        F.lit(f"{repo_url}/compare/{prefix}"), prev_version, F.lit(f"...{prefix}"), new_version)).otherwise(
        F.concat(F.lit(f"{repo_url}/releases/tag/{prefix}"), new_version))
    return unrel, new


def link_order(links: DataFrame, version_col: str = "link_version") -> DataFrame:
    """L3: Unreleased first, then versions in string order."""
    return links.orderBy(F.when(F.col(version_col) == "Unreleased", 0).otherwise(1), version_col)


# ---------------------------------------------------------------- render

def render_update(lines: DataFrame, new_entries: DataFrame, file_col: str = "file",
                  line_no_col: str = "line_no", line_col: str = "line",
                  new_versions: DataFrame | Callable[[DataFrame], DataFrame] | None = None, today: str | None = None,
                  repo_url: str = REPO_URL, prefix: str = VERSION_PREFIX) -> DataFrame:
    """the updated changelog of every file as line rows
    ``file, block, k1, k2, k3, k4, k5, line``; sorting by the seven keys and
    joining with newlines gives the file. The keys are sort keys, not ranks,
    so no global numbering pass is needed.

    Blocks: 0 header lines; 1 the Unreleased heading; 2 the sections in W7
    order, each with its merged entries (existing + new not yet present, J4)
    sorted case-insensitively and stably (L2); 3 two blank lines; 4 the lines
    kept after the Unreleased block; 5 the link lines, Unreleased first, then
    by version string (L3). New entries carry ``section, entry`` and an ``seq``
    order column; entries are full lines (``- ...``).

    Block 4: if a released version follows the first Unreleased heading, everything
    from that version on, minus further Unreleased headings; else everything from the
    first released version on, a version heading that follows a section getting a
    blank line before it.

    Finalising (``new_versions`` and ``today``): block 1 also holds
    ``## [<new>] - <today>``; block 4 is the reference's release copy: after the first
    released version, a line is kept only when the last section/version heading before
    it is a section heading (so the first heading of each block is dropped), and kept
    version headings get a blank line before them; links get the new Unreleased compare
    link and the new version's link (J10/F34). ``new_versions`` has ``file,
    new_version``, or is a function that makes it of the classified lines.

    The lines are classified, shuffled and stored once; one grouped aggregate gives what
    a file's blocks depend on, and one pass over the lines joined with it gives blocks 0
    and 4.
    """
    finalize = new_versions is not None
    if finalize and not today:
        raise ValueError("finalising needs today's date")
    c = classify_lines(lines.select(file_col, line_no_col, line_col), line_col)
    is_v = F.col("kind") == "version"
    is_u = is_v & F.col(line_col).contains("[Unreleased]")
    is_rel = is_v & ~F.col(line_col).contains("[Unreleased]")
    flag = lambda cond: F.when(cond, F.lit(True))
    c = c.withColumns({"_open": flag(is_v & (F.col("version") == "Unreleased")), "_sec": _section_state(), "_un": flag(is_u), "_rel": flag(is_rel),
                       "_any": flag(is_v), "_h": F.when(F.col("kind").isin("version", "section"), F.col("kind"))})
    c = ordered_scan(c, file_col, [line_no_col], {
        "_in": ("_open", LAST), "_in_sec": ("_sec", LAST), "_after_un": ("_un", LAST), "_after_any": ("_any", LAST),
        "_rel_before": ("_rel", BEFORE), "_head_before": ("_h", BEFORE)})
    at = lambda cond: F.min(F.when(cond, F.col(line_no_col)))
    facts = c.groupBy(file_col).agg(at(is_u).alias("_u"), at(is_rel & F.col("_after_un")).alias("_main"), at(is_rel).alias("_first"))

    def rows(df, block, k1, k2=F.lit(0), k3=F.lit(""), k4=F.lit(0), k5=F.lit(0), line=None):
        return df.select(file_col, F.lit(block).alias("block"), k1.cast("long").alias("k1"), k2.cast("int").alias("k2"),
                         k3.cast("string").alias("k3"), k4.cast("long").alias("k4"), k5.cast("long").alias("k5"),
                         line.alias("line"))

    fixed_rows = [(1, 0, ""), (1, 1, "## [Unreleased]"), (3, 0, ""), (3, 1, "")]
    if finalize:
        fixed_rows += [(1, 2, ""), (1, 3, "\u0000")]      # "\u0000": the new version heading
    # a handful of fixed lines per file, generated per file (no join)
    fixed_arr = F.array(*[F.struct(F.lit(b).alias("_b"), F.lit(k).cast("long").alias("_k"), F.lit(l).alias("_l"))
                          for b, k, l in fixed_rows])
    fx = facts.select(file_col, F.inline(fixed_arr))
    if finalize:
        if callable(new_versions):
            new_versions = new_versions(c)
        nv = new_versions.select(file_col, F.col("new_version").alias("_nv"))
        fx = fx.join(nv, file_col, "left").withColumn("_l", F.when(
            F.col("_l") == "\u0000", F.concat(F.lit("## ["), F.col("_nv"), F.lit(f"] - {today}"))).otherwise(F.col("_l")))
    fixed = fx.select(file_col, F.col("_b").alias("block"), F.col("_k").alias("k1"), F.lit(0).alias("k2"),
                      F.lit("").alias("k3"), F.lit(0).cast("long").alias("k4"), F.lit(0).cast("long").alias("k5"),
                      F.col("_l").alias("line")).filter(F.col("line").isNotNull())

    # Blocks 0 and 4: a line is a header line, a kept line, a kept line after a blank one, or nothing.
    header = F.col("_after_any").isNull() & (F.col("kind") != "link")
    after_section = F.coalesce(F.col("_head_before") == "section", F.lit(False))
    if finalize:
        own = c
        keep = F.coalesce(F.col("_rel_before"), F.lit(False)) & after_section
        blank = keep & is_v
    else:
        own = c.join(facts.select(file_col, "_main", "_first"), file_col)
        main = F.col("_main").isNotNull()
        keep = F.coalesce(F.when(main, (F.col(line_no_col) >= F.col("_main")) & ~is_u).otherwise(F.col(line_no_col) >= F.col("_first")), F.lit(False))
        blank = keep & ~main & is_v & (F.col(line_no_col) > F.col("_first")) & after_section
    out = lambda cond, block, k2, line: F.when(cond, F.struct(F.lit(block).alias("block"), F.lit(k2).alias("k2"), line.alias("line")))
    made = F.array_compact(F.array(out(header, 0, 0, F.col(line_col)), out(blank, 4, 0, F.lit("")), out(keep, 4, 1, F.col(line_col))))
    kept = own.select(file_col, F.col(line_no_col).cast("long").alias("k1"), F.inline_outer(made)).filter(F.col("block").isNotNull())
    kept = kept.select(file_col, "block", "k1", "k2", F.lit("").alias("k3"), F.lit(0).cast("long").alias("k4"), F.lit(0).cast("long").alias("k5"), "line")

    existing = _open_entries(c, "_in", "_in_sec").select(
        file_col, F.col("_in_sec").alias("section"), F.col(line_col).alias("entry"), F.lit(0).alias("_src"), F.col(line_no_col).cast("long").alias("_pos"))
    new = new_entries.select(file_col, "section", "entry", F.lit(1).alias("_src"), F.col("seq").cast("long").alias("_pos"))
    merged = merge_entries(existing, new, [file_col, "section", "entry"])
    order = _order_of_sections(c.filter(F.col("kind") == "section"), facts.withColumnsRenamed({"_u": "_s", "_main": "_e"}), file_col, line_no_col)
    ents = merged.join(order, [file_col, "section"])
    heads = ents.select(file_col, "section", "pos").distinct()
    sec_lines = heads.select(file_col, F.lit(2).alias("block"), F.col("pos").cast("long").alias("k1"), F.inline(F.array(
        F.struct(F.lit(0).alias("k2"), F.lit("").alias("_l")), F.struct(F.lit(1).alias("k2"), F.concat(F.lit("### "), F.col("section")).alias("_l")))))
    sec_lines = sec_lines.select(file_col, "block", "k1", "k2", F.lit("").alias("k3"), F.lit(0).cast("long").alias("k4"),
                                 F.lit(0).cast("long").alias("k5"), F.col("_l").alias("line"))
    # stable case-insensitive order: lower(entry), then existing before new, then position
    ent_lines = rows(ents, 2, F.col("pos"), F.lit(2), F.lower("entry"), F.col("_src"), F.col("_pos"), F.col("entry"))
    # the reference keeps links in a dict: the last line of a version wins
    links = (c.filter(F.col("kind") == "link").groupBy(file_col, "link_version")
             .agg(F.max_by("url", line_no_col).alias("url")))
    if finalize:
        prev = (links.filter(F.col("link_version") != "Unreleased").groupBy(file_col)
                .agg(F.max("link_version").alias("_prev")))
        nv = new_versions.select(file_col, F.col("new_version").alias("_nv")).join(prev, file_col, "left")
        unrel, newlink = release_links(F.col("_nv"), F.col("_prev"), repo_url, prefix)
        added = nv.select(file_col, F.inline(F.array(F.struct(F.lit("Unreleased").alias("link_version"), unrel.alias("url")),
                                                     F.struct(F.col("_nv").alias("link_version"), newlink.alias("url")))))
        links = links.join(added.select(file_col, "link_version"), [file_col, "link_version"], "left_anti") \
            .unionByName(added)
    link_lines = rows(links, 5, F.when(F.col("link_version") == "Unreleased", 0).otherwise(1), F.lit(0),
                      F.col("link_version"), line=F.concat(F.lit("["), F.col("link_version"), F.lit("]: "), F.col("url")))
    return fixed.unionByName(kept).unionByName(sec_lines).unionByName(ent_lines).unionByName(link_lines)


RENDER_KEYS = ["block", "k1", "k2", "k3", "k4", "k5"]


def render_text(rendered: DataFrame, file_col: str = "file") -> DataFrame:
    """Small files only (tests, previews): the rendered lines of each file
    joined into one string. For large files write the rows sorted by
    ``file`` + ``RENDER_KEYS`` (see ``bundle.write_ordered_text``)."""
    return rendered.groupBy(file_col).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(*RENDER_KEYS, "line"))), lambda s: s["line"]), "\n").alias("text"))
