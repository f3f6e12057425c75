"""Metrics of a snapshot: files(package, version, path, content) in, one row per snapshot out.

Each function reads the files once. A rate without a denominator is null, an absent input null, a
measured absence 0.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions import parse
from chronolake.functions.rules import KEYS, Rule, apply
from chronolake.functions.text import basename, blank_to_null, extension, line_count, lines, or_empty, ratio, strip, words

# Paths and extensions.
R_SOURCE = r"^R/.*\.[Rr]$"
TEST_SOURCE = r"^tests/.*\.[Rr]$"
COMPILED = r"(?i)^src/[^/].*\.(c|cc|cpp|cxx|h|hpp|hxx|f|f90|f95)$"
NOT_CODE = (
    r"(?i)\.(rda|rdata|pdf|png|jpg|jpeg|gif|bmp|svg|ico|woff|woff2|eot|ttf|otf|gz|zip|tar|bz2|xz|7z|"
    r"dll|so|dylib|o|a|lib|pyd|class|jar|pyc|xlsx|xls|docx|doc|pptx|ppt|mp3|mp4|ogg|wav|avi|mov)$"
)
NOT_TEXT = (
    r"(?i)\.(rda|rdata|pdf|png|jpg|jpeg|gif|bmp|svg|ico|woff|woff2|eot|ttf|otf|gz|zip|tar|bz2|xz|7z|"
    r"dll|so|dylib|o|a|lib|pyd|class|jar|pyc|xlsx|xls|docx|doc|pptx|ppt|mp3|mp4|ogg|wav|avi|mov|"
    r"rds|sam|bam|bai|cram|fasta|fa|fastq|fq|vcf|bcf|bed|wig|bedgraph|bigwig|bw|bigbed|bb)$"
)
SUM_FILE = r"(^|/)MD5$"
VIGNETTE = r"^vignettes/.*\.([Rr](md|nw|html|rst|tex)|qmd|md)$"
READMES = ["README.md", "README.Rmd", "README.qmd", "README.markdown"]
NEWS = ["NEWS.md", "NEWS"]
WORKFLOW = r"^\.github/workflows/.*\.ya?ml$"
CONFIGURE = ["configure", "configure.win", "cleanup", "cleanup.win"]
BUILD_FILES = ["src/Makevars", "src/Makevars.win", "src/Makevars.in", "src/Makevars.ucrt", "configure", "configure.ac", "configure.in"]
VENDORED = ["sqlite3.c", "sqlite3.h", "json.hpp", "miniz.c", "miniz.h", "stb_image.h", "stb_image_write.h", "nanosvg.h", "nanosvgrast.h", "xxhash.h", "xxhash.c", "tinyxml2.cpp", "tinyxml2.h", "pugixml.cpp", "pugixml.hpp"]

# Patterns of the rules.
HOOK = r"\.on(?:Load|Attach)\s*<-\s*function"
HOOK_WRITE = r"writeLines?\s*\(|writeBin\s*\(|\bcat\s*\(\s*[^)]*,\s*(?:file|con)\s*=|(?<![A-Za-z0-9_.])file\s*\(|\bsink\s*\(|write\.csv\s*\(|write\.table\s*\("
HOOK_NETWORK = r"download\.file\s*\(|\burl\s*\(|\bcurl\s*\(|httr::|RCurl::|curl::"
NSE = r"\b(eval|substitute|quote|bquote|match\.call|sys\.call)[ \t\n\x0b\f\r]*\("
MUTATOR = r"<<-|\boptions\s*\([^)]*=|\bpar\s*\([^)]*=|\bsetwd\s*\(|\bSys\.setenv\s*\(|\bsink\s*\(|\bfile\s*\(|\burl\s*\(|\bpipe\s*\(|\bgzfile\s*\(|\bbzfile\s*\(|\bxzfile\s*\(|\btextConnection\s*\("
ISOLATION = ["withr", "mockr", "httptest2", "webfakes"]
FLAGS = ["-march=native", "-O3", "-funroll-loops", "-ffast-math"]

UNSAFE = [
    Rule("unsafe_pattern_score", R_SOURCE, r"eval\s*\(\s*parse\s*\(\s*text\s*=", weight=3),
    Rule("unsafe_pattern_score", R_SOURCE, r"system\s*\(\s*paste\s*\(", weight=2),
    Rule("unsafe_pattern_score", R_SOURCE, r"system2\s*\([^\n]*paste\s*\(", weight=2),
    Rule("unsafe_pattern_score", R_SOURCE, r"=\s*[A-Za-z_.]", unit="lines", weight=2, source="set_lines"),
    Rule("unsafe_pattern_score", R_SOURCE, r"download\.file\s*\(|\burl\s*\(|\bcurl\s*\(", weight=2, where=HOOK),
]
QUOTED = r"[=:]\s*[\"'][A-Za-z0-9+/=_\-]{16}"  # what a stated key can't be without, found at once: the names before it, in either case, are slow to look for
SECRETS = [
    Rule("secret_pattern_count", "", r"AKIA[0-9A-Z]{16}", most_bytes=1_000_000),
    Rule("secret_pattern_count", "", r"g(?:h[pous]_|ithub_pat_)[A-Za-z0-9_]{36,}", most_bytes=1_000_000),
    Rule("secret_pattern_count", "", r"(?i)(api[_-]?key|api[_-]?secret|secret[_-]?key|access[_-]?token)\s*[=:]\s*[\"'][A-Za-z0-9+/=_\-]{16,}[\"']", most_bytes=1_000_000, where=QUOTED),
    Rule("secret_pattern_count", "", r"(?i)(password|passwd|api_?key|auth_?token|secret)\s*=\s*[\"'][A-Za-z0-9+/]{40,}={0,2}[\"']", most_bytes=1_000_000, where=QUOTED),
]
STATE = [
    Rule("global_state_writes", R_SOURCE, r"<<-", unit="lines", source="bare"),
    Rule("global_state_writes", R_SOURCE, r"\bassign\s*\([^)]*(?:\.GlobalEnv|globalenv\s*\(|baseenv\s*\()", unit="lines", source="bare"),
    Rule("global_state_writes", R_SOURCE, r"\boptions\s*\([^)]*=", unit="lines", source="bare"),
    Rule("global_state_writes", R_SOURCE, r"\bSys\.setenv\s*\(", unit="lines", source="bare"),
    Rule("deprecated_idioms", R_SOURCE, r"(?<![A-Za-z0-9_.])[TF](?![A-Za-z0-9_.=])", unit="lines", source="bare"),
    Rule("deprecated_idioms", R_SOURCE, r"\b1:(?:length|nrow|ncol)\s*\(", unit="lines", source="bare"),
    Rule("deprecated_idioms", R_SOURCE, r"^[ \t]{2,}.*\b(?:require|library)\s*\(", unit="lines", source="bare"),
    Rule("deprecated_idioms", R_SOURCE, r"\.Internal\s*\(", unit="lines", source="bare"),
    Rule("debug_artifacts", R_SOURCE, r"^\s*browser\s*\(\s*\)", unit="lines", source="bare"),
    Rule("debug_artifacts", R_SOURCE, r"^\s*(?:print|cat)\s*\(", unit="lines", source="bare", unless=r"\b(?:message|warning|stop)\s*\("),
]

# License tokens that are known, and those of them that are open source.
LICENSES_OSI = ["GPL-2", "GPL-3", "GPL (>= 2)", "GPL (>= 3)", "LGPL-2", "LGPL-2.1", "LGPL-3", "LGPL (>= 2)", "LGPL (>= 2.1)", "MIT", "BSD_2_clause", "BSD_3_clause", "Apache License 2.0", "Apache License (>= 2)", "MPL-2.0", "Artistic-2.0", "AGPL-3", "AGPL (>= 3)"]
LICENSES_KNOWN = ["GPL-2", "GPL-3", "GPL (>= 2)", "GPL (>= 3)", "LGPL-2", "LGPL-2.1", "LGPL-3", "LGPL (>= 2)", "LGPL (>= 2.1)", "MIT", "BSD_2_clause", "BSD_3_clause", "Apache License 2.0", "Apache License (>= 2)", "MPL-2.0", "Artistic-2.0", "AGPL-3", "AGPL (>= 3)", "CC0", "CC BY 4.0", "CC-BY-4.0", "Unlimited", "file LICENSE", "file LICENCE"]
LICENSES_TEMPLATE = ["MIT", "BSD_2_clause", "BSD_3_clause"]


def _is(pattern: str) -> Column:
    return F.col("path").rlike(pattern)


def _named(names: list[str]) -> Column:
    return F.col("path").isin(*names)


def _first_of(names: list[str]) -> Column:
    """Content of the first of these files that is there (aggregate)."""
    rank = F.when(_named(names), F.array_position(F.lit(names), F.col("path")))
    return F.min_by("content", rank)


def snapshots(files: DataFrame) -> DataFrame:
    return files.select(*KEYS).distinct()


def structure(files: DataFrame) -> DataFrame:
    """n_files, lines by area, share compiled, has_src and lines by extension."""
    code = ~_is(NOT_CODE) & ~_is(SUM_FILE)
    areas = {"loc_r": "^R/", "loc_src": COMPILED, "loc_tests": "^tests/", "loc_docs": "^man/", "loc_vignettes": "^vignettes/"}
    each = files.select(*KEYS, "path", F.when(code, line_count("content")).otherwise(0).alias("n"), code.alias("code"))
    any_area = F.lit(False)
    for p in areas.values():
        any_area = any_area | _is(p)
    ext = F.coalesce(F.regexp_extract(basename("path"), r"\.([A-Za-z0-9]+)$", 1), F.lit(""))
    each = each.withColumn("ext", F.when(F.col("code") & any_area, F.when(ext == "", "(none)").otherwise(ext)))
    by_ext = each.groupBy(*KEYS, "ext").agg(F.count("*").alias("f"), F.sum("n").alias("n"), *(F.sum(F.when(_is(p), F.col("n")).otherwise(0)).alias(a) for a, p in areas.items()), F.bool_or(_is(COMPILED)).alias("s"))
    out = by_ext.groupBy(*KEYS).agg(
        F.sum("f").alias("n_files"), *(F.sum(a).alias(a) for a in areas), F.bool_or("s").alias("has_src"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("ext").isNotNull(), F.struct("ext", "n"))))).alias("lang_breakdown")
    )
    total = sum((F.col(a) for a in areas), F.lit(0))
    return out.withColumn("loc_total", total).withColumn("compiled_share", F.when(total > 0, F.col("loc_src") / total).otherwise(0.0))


def size_by_class(rows: DataFrame, by: list[str], text: str) -> DataFrame:
    """Files, lines and bytes of each class."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_files"), F.sum(line_count(text)).alias("n_lines"), F.sum(F.octet_length(text)).cast("bigint").alias("n_bytes"))


def _prepared(files: DataFrame) -> DataFrame:
    """Adds bare (lines up to their first #) and set_lines (the lines that set environment variables,
    without what stands in quotes) of sources."""
    source = lambda c: F.when(_is(R_SOURCE), c).otherwise("")
    cut = lambda x: F.regexp_replace(F.regexp_replace(x, "'[^']*'", "''"), '"[^"]*"', '""')
    set_lines = F.array_join(F.transform(F.filter(lines("content"), lambda x: x.rlike(r"Sys\.setenv\s*\(")), cut), "\n")
    return files.withColumn("bare", source(F.regexp_replace("content", "#[^\n]*", ""))).withColumn("set_lines", source(set_lines))


def rule_metrics(files: DataFrame) -> DataFrame:
    """unsafe_pattern_score, secret_pattern_count and the three densities per 1000 source lines."""
    text = ~_is(NOT_TEXT) & ~_is(SUM_FILE)
    df = _prepared(files).withColumn("content", F.when(text, F.col("content")).otherwise(""))
    rules = apply(df, UNSAFE + SECRETS + STATE)
    loc = files.groupBy(*KEYS).agg(F.sum(F.when(_is(R_SOURCE), line_count("content")).otherwise(0)).alias("r_loc"))
    per = lambda c: ratio(F.col(c) * 1000, F.col("r_loc"))
    return rules.join(loc, KEYS).select(*KEYS, "unsafe_pattern_score", "secret_pattern_count", per("global_state_writes").alias("global_state_write_density"), per("deprecated_idioms").alias("deprecated_idiom_density"), per("debug_artifacts").alias("debug_artifact_density"))


def install_surface(files: DataFrame) -> DataFrame:
    """configure and cleanup scripts with their lines; file writes and network use in files with hooks."""
    hook = _is(R_SOURCE) & F.col("content").rlike(HOOK)
    return files.groupBy(*KEYS).agg(
        F.array_sort(F.collect_set(F.when(_named(CONFIGURE), F.col("path")))).alias("configure_files"),
        F.sum(F.when(_named(CONFIGURE), line_count("content")).otherwise(0)).alias("configure_loc"),
        F.bool_or(hook & F.col("content").rlike(HOOK_WRITE)).alias("hook_file_write"),
        F.bool_or(hook & F.col("content").rlike(HOOK_NETWORK)).alias("hook_network"),
    )


def external_libraries(files: DataFrame) -> DataFrame:
    """libraries: distinct names after -l or in AC_CHECK_LIB of build files."""
    text = F.when(_named(BUILD_FILES), F.col("content")).otherwise("")
    flags = F.regexp_extract_all(text, F.lit(r"-l([A-Za-z][A-Za-z0-9_-]*)"), F.lit(1))
    checks = F.regexp_extract_all(text, F.lit(r"AC_CHECK_LIB\s*\(\s*([A-Za-z][A-Za-z0-9_-]*)"), F.lit(1))
    return files.groupBy(*KEYS).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat(flags, checks))))).alias("libraries"))


def bundled_code(files: DataFrame) -> DataFrame:
    """Known third-party files under src/ or inst/, and license files below src/."""
    hit = (_is("^(src|inst)/") & basename("path").isin(*VENDORED)) | _is(r"^src/.+/(LICENSE|COPYING)(\.[A-Za-z]+)?$")
    return files.groupBy(*KEYS).agg(F.array_sort(F.collect_set(F.when(hit, F.col("path")))).alias("bundled_files"))


def tests(files: DataFrame) -> DataFrame:
    """Tests and CI: presence, ratio to source lines, snapshots, isolation libraries, seeds, systems."""
    # The patterns here are fixed values.
    test, source = _is("^tests/"), _is(TEST_SOURCE)
    c = F.col("content")
    random, seeded = c.rlike(r"\b(?:sample|runif|rnorm|rbinom)\s*\("), c.rlike(r"\bset\.seed\s*\(")
    libs = {lib: rf"\b{lib}::|(?:library|require)\(\s*['\"]?{lib}['\"]?\s*\)" for lib in ISOLATION} | {"local_mocked_bindings": r"\blocal_mocked_bindings\s*\("}
    flow = _is(WORKFLOW)
    arrays = lambda key: F.array_distinct(F.filter(F.transform(F.flatten(F.transform(F.regexp_extract_all(c, F.lit(rf"(?m)^\s+{key}:\s*\[([^\]]+)\]"), F.lit(1)), lambda x: F.split(x, ","))), lambda x: F.regexp_replace(F.trim(x), "[\"'`]", "")), lambda x: x != ""))
    os_n, r_n = F.size(arrays("os")), F.size(arrays("r(?:-version)?"))
    crossed = F.when((os_n > 0) & (r_n > 0), os_n * r_n).otherwise(F.greatest(os_n, r_n))
    value = lambda x, key: F.regexp_extract(x, rf"\b{key}:\s*['\"]?([^,'\"{{}}\s]+)", 1)
    pairs = F.transform(F.regexp_extract_all(c, F.lit(r"\{[^}\n]*\bos:\s*[^}\n]+\}"), F.lit(0)), lambda x: F.concat(value(x, "os"), F.lit(":"), F.coalesce(F.nullif(value(x, "r(?:-version)?"), F.lit("")), F.lit("any"))))
    breadth = F.when(flow, F.greatest(crossed, F.size(F.array_distinct(pairs)))).otherwise(0)
    systems = {"github-actions": flow, "travis": _named([".travis.yml"]), "appveyor": _named(["appveyor.yml"]), "circleci": _is(r"^\.circleci/")}
    snap = F.when(source, F.regexp_count(c, F.lit(r"expect_snapshot(?:_file)?\s*\("))).otherwise(0) + _is("^tests/testthat/_snaps/").cast("int")
    out = files.groupBy(*KEYS).agg(
        F.bool_or(test).alias("has_tests"),
        F.sum(F.when(test, line_count("content")).otherwise(0)).alias("t"),
        F.sum(F.when(_is(R_SOURCE), line_count("content")).otherwise(0)).alias("r"),
        F.sum(snap).alias("snapshot_test_count"),
        *(F.bool_or(test & c.rlike(p)).alias(f"lib_{i}") for i, p in enumerate(libs.values())),
        F.count_if(source & random).alias("n_random"),
        F.count_if(source & random & seeded).alias("n_seeded"),
        *(F.bool_or(p).alias(f"ci_{i}") for i, p in enumerate(systems.values())),
        F.max(breadth).alias("ci_matrix_breadth"),
        F.bool_or(flow & c.contains("pull_request")).alias("ci_pr_gated"),
    )
    listed = lambda prefix, names: F.array_compact(F.array(*(F.when(F.col(f"{prefix}_{i}"), F.lit(n)) for i, n in enumerate(names))))
    return out.select(
        *KEYS, "has_tests", ratio(F.col("t"), F.col("r")).alias("test_to_code_ratio"), "snapshot_test_count", listed("lib", libs).alias("test_isolation_libs"), ratio(F.col("n_seeded"), F.col("n_random")).alias("stochastic_seed_discipline"),
        (F.size(listed("ci", systems)) > 0).alias("ci_present"), listed("ci", systems).alias("ci_type"), "ci_matrix_breadth", "ci_pr_gated",
    )


def prose_words(text: Column) -> Column:
    """Words of a readme without fenced code and lines of badges or images."""
    # The patterns here are fixed values.
    kept = F.regexp_replace(text, r"(?s)```[^\n]*\n.*?```", "")
    kept = F.regexp_replace(kept, r"(?m)^\s*(\[!\[|<img\s|\[\[img).*$", "")
    return F.size(F.filter(F.split(F.trim(kept), r"\s+"), lambda x: x != ""))


def news_quality(text: Column) -> Column:
    """Thirds for version headings, bullets, and headings in descending order (two at least)."""
    # The patterns here are fixed values.
    head = r"^(#{1,4}\s[^\n]*\d+\.\d+|[Vv]ersion\s+\d+\.\d+|[Cc]hanges?\s+(in|for)\s+(version\s+)?\d+\.\d+|\d+\.\d+(?:\.\d+)?\s*([-_(]|$))"
    rows = F.split(text, "\n")
    heads = F.filter(rows, lambda x: x.rlike(head))
    versions = F.flatten(F.transform(heads, lambda x: F.regexp_extract_all(x, F.lit(r"\d+\.\d+(?:\.\d+)*"), F.lit(0))))
    keys = F.transform(versions, lambda v: F.transform(F.split(v, r"\."), lambda p: p.cast("bigint")))
    falls = F.aggregate(keys, F.struct(F.lit(True).alias("ok"), F.lit(None).cast("array<bigint>").alias("last")), lambda a, k: F.struct((a["ok"] & (a["last"].isNull() | (a["last"] >= k))).alias("ok"), k.alias("last")))["ok"]
    met = (F.size(heads) > 0).cast("int") + F.exists(rows, lambda x: x.rlike(r"^\s*[-*+]\s+\S")).cast("int") + ((F.size(heads) >= 2) & (F.size(versions) >= 2) & falls).cast("int")
    return F.when(text.isNull(), None).when(F.trim(text) == "", 0.0).otherwise(met / 3.0)


def readme_and_news(files: DataFrame) -> DataFrame:
    out = files.groupBy(*KEYS).agg(
        F.bool_or(_named(READMES)).alias("has_readme"), _first_of(READMES).alias("_readme"), F.bool_or(_named(["_pkgdown.yml", "pkgdown/_pkgdown.yml"])).alias("has_pkgdown"), F.bool_or(_named(NEWS)).alias("news_present"), _first_of(NEWS).alias("_news"),
        F.bool_or(_named(["CODE_OF_CONDUCT.md", ".github/CODE_OF_CONDUCT.md"])).alias("has_code_of_conduct"), F.bool_or(_named(["CONTRIBUTING.md", ".github/CONTRIBUTING.md"])).alias("has_contributing_guide"),
    )
    return out.withColumn("readme_prose_length", prose_words(F.col("_readme"))).withColumn("news_structure_quality", news_quality(F.col("_news"))).drop("_readme", "_news")


def exports(files: DataFrame) -> DataFrame:
    """(keys, name, is_pattern) of the export directives."""
    d = parse.directives(files.filter(_named(["NAMESPACE"])), KEYS).filter(F.col("kind").isin("export", "exportPattern"))
    return d.select(*KEYS, F.regexp_replace("arg", "^pattern:", "").alias("name"), (F.col("kind") == "exportPattern").alias("is_pattern")).distinct()


def functions(files: DataFrame) -> DataFrame:
    """n_exports, n_internal, nse_surface_n and _frac, triple_colon_count and _pkgs."""
    r = files.filter(_is(R_SOURCE))
    defs, ex = parse.definitions(r, KEYS), exports(files)
    named, patterns = ex.filter("not is_pattern").select(*KEYS, "name"), ex.filter("is_pattern").select(*KEYS, F.col("name").alias("p"))
    by_name = defs.join(named.withColumn("explicit", F.lit(True)), [*KEYS, "name"], "left")
    by_pattern = defs.join(patterns, KEYS).filter(F.expr("name rlike p")).select(*KEYS, "name").distinct().withColumn("matched", F.lit(True))
    defs = by_name.join(by_pattern, [*KEYS, "name"], "left").withColumn("explicit", F.coalesce("explicit", F.lit(False))).withColumn("matched", F.coalesce("matched", F.lit(False)))
    uses = parse.uses(r, KEYS, NSE).groupBy(*KEYS, "name").agg(F.min_by("found", F.struct("path", "line")).alias("found"))
    nse = defs.filter("explicit or matched").join(uses.filter("found"), [*KEYS, "name"]).groupBy(*KEYS).agg(F.count("*").alias("nse"))
    d = defs.groupBy(*KEYS).agg(F.count_if(F.col("matched") & ~F.col("explicit")).alias("extra"), F.count_if(~F.col("matched") & ~F.col("explicit")).alias("internal"))
    e = ex.groupBy(*KEYS).agg(F.count_if(~F.col("is_pattern")).alias("named"))
    colons = F.array_join(F.filter(lines("content"), lambda x: x.contains(":::")), "\n")  # no match runs over lines
    hits = r.select(*KEYS, F.explode(F.regexp_extract_all(colons, F.lit(r"([A-Za-z.][A-Za-z0-9.]*+):::[A-Za-z.]"), F.lit(1))).alias("pkg"))
    hits = hits.groupBy(*KEYS).agg(F.count("*").alias("tc"), F.countDistinct(F.when(F.col("pkg") != F.col("package"), F.col("pkg"))).alias("tp"))
    has = files.groupBy(*KEYS).agg(F.bool_or(_named(["NAMESPACE"])).alias("has"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = has
    for part in (e, d, nse, hits):
        out = out.join(part, KEYS, "left")
    n = F.when(F.col("has"), zero("named") + zero("extra"))
    surface = F.when(F.col("has"), zero("nse"))
    return out.select(*KEYS, n.alias("n_exports"), zero("internal").alias("n_internal"), surface.alias("nse_surface_n"), ratio(surface, n).alias("nse_surface_frac"), zero("tc").alias("triple_colon_count"), zero("tp").alias("triple_colon_pkgs"))


def on_exit_rate(files: DataFrame) -> DataFrame:
    """Share of state-changing function bodies that restore on exit."""
    b = parse.spans(files.filter(_is(R_SOURCE)), KEYS, capped=False).filter(F.col("body").rlike(MUTATOR))
    rate = b.groupBy(*KEYS).agg(F.avg(F.col("body").rlike(r"\bon\.exit\s*\(").cast("double")).alias("on_exit_coverage_rate"))
    return snapshots(files).join(rate, KEYS, "left")


def export_test_linkage(files: DataFrame) -> DataFrame:
    """Share of exports named in the tests; 0 without test text, null without exports."""
    ex = exports(files).filter("not is_pattern").select(*KEYS, "name")
    text = files.filter(_is("^tests/")).select(*KEYS, "content")
    # the names of a package meet each of its tests once, in one row
    plain = lambda x: x.rlike("^[A-Za-z0-9_]+$")
    words = F.split(F.regexp_replace("content", r"\W+", " "), " ")  # the class of word characters and a blank are found much faster than listed ranges
    odd = F.filter("names", lambda x: ~plain(x) & F.regexp_like("content", F.concat(F.lit("\\b\\Q"), x, F.lit("\\E\\b"))))
    met = text.join(ex.groupBy(*KEYS).agg(F.collect_list("name").alias("names")), KEYS)
    seen = met.select(*KEYS, F.explode(F.concat(F.array_intersect(F.filter("names", plain), words), odd)).alias("name"))
    seen = seen.distinct().groupBy(*KEYS).agg(F.count("*").alias("s"))
    n = ex.groupBy(*KEYS).agg(F.count("*").alias("n"))
    return snapshots(files).join(n, KEYS, "left").join(seen, KEYS, "left").select(*KEYS, ratio(F.when(F.col("n").isNotNull(), F.coalesce("s", F.lit(0))), F.col("n")).alias("exported_fn_test_linkage"))


def documentation(files: DataFrame) -> DataFrame:
    """Rates over help files: wrapped examples, undocumented parameters, value, references, coverage."""
    man = files.filter(_is(r"^man/.*\.[Rr]d$"))
    s = parse.sections(man, KEYS)
    first = lambda c: F.min_by(F.when(F.col("command") == c, F.col("content")), F.when(F.col("command") == c, F.col("at")))
    docs = s.groupBy(*KEYS, "path").agg(
        F.collect_set(F.when(F.col("command").isin("name", "alias"), F.trim("content"))).alias("symbols"), first("examples").alias("examples"), first("usage").alias("usage"), first("arguments").alias("arguments"), F.bool_or(F.col("command") == "value").alias("value"), F.bool_or(F.col("command") == "references").alias("refs")
    )
    docs = man.select(*KEYS, "path").join(docs, [*KEYS, "path"], "left").withColumn("symbols", or_empty("symbols"))

    def run(batches):
        for part in parse.slices(batches, ["examples", "usage", "arguments"]):
            rows = []
            for examples, usage, arguments in zip(*(part[c].to_pylist() for c in ("examples", "usage", "arguments")), strict=True):
                wrapped = None
                if examples is not None:
                    body = examples.strip()
                    start = parse.WRAPPER.match(body)
                    end = parse.balanced(body, start.end()) if start else None
                    wrapped = end is not None and not body[end + 1 :].strip()
                params = parse.usage_params(usage) if usage is not None else []
                told = set(parse.item_names(arguments or ""))
                missing = [p for p in params if p not in told]
                rows.append((wrapped, len(missing) / len(params) if params else None))
            wrapped, undocumented = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([*(part[k] for k in kept), pa.array(wrapped, pa.bool_()), pa.array(undocumented, pa.float64())], names=[*kept, "wrapped", "undocumented"])

    kept = [*KEYS, "path", "symbols", "value", "refs"]  # they go along, so that the sections are made once
    kinds = dict(docs.dtypes)
    docs = docs.select(*kept, "examples", "usage", "arguments").mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in kept) + ", wrapped boolean, undocumented double")
    ex = exports(files).filter("not is_pattern").groupBy(*KEYS).agg(F.collect_set("name").alias("exported"))
    docs = docs.join(ex, KEYS, "left").withColumn("own", F.size(F.array_intersect("symbols", or_empty("exported"))) > 0)
    out = docs.groupBy(*KEYS).agg(
        F.avg(F.col("wrapped").cast("double")).alias("dontrun_example_ratio"),
        F.avg(F.when(F.col("own"), F.col("undocumented"))).alias("undocumented_params_rate"),
        F.avg(F.when(F.col("own"), F.coalesce("value", F.lit(False)).cast("double"))).alias("value_doc_rate"),
        F.avg(F.coalesce("refs", F.lit(False)).cast("double")).alias("references_coverage"),
        F.array_distinct(F.flatten(F.collect_list("symbols"))).alias("all_symbols"),
    )
    out = snapshots(files).join(out, KEYS, "left").join(ex, KEYS, "left")
    covered = F.size(F.array_intersect(or_empty("exported"), or_empty("all_symbols")))
    return out.withColumn("roxygen_doc_coverage", ratio(F.when(F.col("exported").isNotNull(), covered), F.size("exported"))).drop("all_symbols", "exported")


def build_flags(files: DataFrame) -> DataFrame:
    """cxx_standard_required and the distinct non-portable flags of the Makevars files."""
    rows = files.filter(_is(r"^src/Makevars(\.win)?$")).select(*KEYS, "path", F.posexplode(F.split("content", "\n")).alias("n", "l")).filter(~F.col("l").rlike(r"^\s*#"))
    std = F.nullif(F.regexp_extract("l", r"^\s*CXX_STD\s*=\s*CXX(\d+)", 1), F.lit(""))
    flags = F.concat(F.array_compact(F.array(*(F.when(F.col("l").contains(x), F.lit(x)) for x in FLAGS))), F.regexp_extract_all("l", F.lit(r"-[IL]/\S+"), F.lit(0)))
    out = rows.groupBy(*KEYS).agg(F.concat(F.lit("C++"), F.min_by(std, F.when(std.isNotNull(), F.struct("path", "n")))).alias("cxx_standard_required"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(flags)))).alias("nonportable_compiler_flags"))
    return snapshots(files).join(out, KEYS, "left").withColumn("nonportable_compiler_flags", or_empty("nonportable_compiler_flags"))


def license_tokens(license: Column) -> Column:
    """Alternatives of a license field without ``+ file LICENSE``; a bare file reference stays."""
    parts = F.filter(F.transform(F.split(license, r"\|"), lambda x: F.trim(F.regexp_replace(x, "[ \t]+", " "))), lambda x: x != "")
    bare = F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"\s*\+\s*file\s+LICEN[SC]E\s*$", "")))
    return F.transform(bare, lambda x: F.when(x == "", "file LICENSE").otherwise(x))


def all_in(tokens: Column, known: list[str]) -> Column:
    """Every token is in the list; null without tokens."""
    return F.when(F.size(tokens) > 0, F.forall(tokens, lambda t: F.array_contains(F.lit(known), t)))


def _entries(c: str) -> Column:
    return F.filter(words(F.coalesce(F.col(c), F.lit(""))), lambda x: F.trim(F.regexp_replace(x, r"\s*\(.*", "")) != "R")


def described(files: DataFrame) -> DataFrame:
    """What the DESCRIPTION file states: license, dependencies, maintainer, requirements and so on."""
    d = parse.fields(files.filter(_named(["DESCRIPTION"])), KEYS)
    names = ["License", "Imports", "Depends", "Suggests", "LinkingTo", "Enhances", "Remotes", "SystemRequirements", "Maintainer", "Title", "Description", "Author", "Authors@R", "Config/testthat/edition"]
    f = snapshots(files).join(parse.field(d, KEYS, *names), KEYS, "left")
    has_license = files.groupBy(*KEYS).agg(_first_of(["LICENSE", "LICENCE"]).alias("_lic"))
    f = parse.persons(f.join(has_license, KEYS), "Authors@R")
    c = lambda n: F.col(f"`{n}`")
    tokens = F.when(blank_to_null("License").isNotNull(), license_tokens(c("License"))).otherwise(F.array().cast("array<string>"))
    bare = lambda x: strip(F.regexp_replace(x, r"\s*\(.*", ""))
    deps = F.array_distinct(F.transform(F.concat(_entries("Imports"), _entries("Depends")), bare))
    every = F.concat(_entries("Imports"), _entries("Depends"))
    remotes = words(F.coalesce(c("Remotes"), F.lit("")))
    required = F.filter(F.transform(F.split(c("SystemRequirements"), r",|\band\b"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    unfilled = F.exists(tokens, lambda t: F.array_contains(F.lit(LICENSES_TEMPLATE), t)) & F.col("_lic").rlike(r"\bYEAR\b|\bCOPYRIGHT HOLDER\b")
    refers = F.coalesce(c("License").rlike(r"\bfile\s+LICEN[SC]E\b"), F.lit(False))
    authors = F.when(blank_to_null("Authors@R").isNotNull(), F.when(F.size("persons") > 0, F.col("persons"))).when(blank_to_null("Author").isNotNull(), parse.free_authors(c("Author")))
    return f.select(
        *KEYS,
        blank_to_null("License").alias("license"),
        all_in(tokens, LICENSES_KNOWN).alias("spdx_valid"),
        all_in(tokens, LICENSES_OSI).alias("osi_approved"),
        F.when(~refers, None).when(F.coalesce(F.trim("_lic"), F.lit("")) == "", False).otherwise(~unfilled).alias("license_file_completeness"),
        F.when(blank_to_null("Authors@R").isNotNull(), c("Authors@R").rlike("[\"]cph[\"]|[']cph[']")).when(blank_to_null("Author").isNotNull(), True).alias("copyright_holder_declared"),
        deps.alias("dep_list"),
        F.size(deps).alias("n_deps_direct"),
        *(blank_to_null(n).alias(n.lower()) for n in ("Imports", "Depends", "Suggests", "LinkingTo", "Enhances")),
        ratio(F.size(F.filter(every, lambda x: x.contains(">="))), F.size(every)).alias("dep_constraint_coverage"),
        F.size(remotes).alias("non_registry_remotes"),
        F.transform(remotes, lambda x: F.when(x.contains("::"), F.regexp_replace(x, "::.*", "")).otherwise("github")).alias("remote_schemes"),
        F.when(F.size(required) > 0, F.size(F.array_distinct(required))).alias("system_requirements_count"),
        F.nullif(F.regexp_extract("Depends", r"\bR\s*\(\s*>=\s*([0-9]+\.[0-9]+(?:\.[0-9]+)?)\s*\)", 1), F.lit("")).alias("min_r_version"),
        F.trim(c("Config/testthat/edition")).try_cast("int").alias("testthat_edition"),
        F.nullif(F.trim(F.regexp_replace("Maintainer", r"\s*<.*$", "")), F.lit("")).alias("maintainer"),
        F.nullif(F.regexp_extract("Maintainer", r"<([^>]+)>", 1), F.lit("")).alias("maintainer_email"),
        blank_to_null("Title").alias("title"),
        blank_to_null("Description").alias("description"),
        authors.alias("authors"),
        F.when(authors.isNotNull(), F.size(authors)).alias("n_authors"),
    )


def vignettes(files: DataFrame) -> DataFrame:
    """A row per vignette source: format, engine, output, title, authors, builder, and whether it is
    prebuilt, precomputed and has code."""
    # The patterns here are fixed values.
    v = files.filter(_is(VIGNETTE))
    front = parse.front_matter(v, KEYS).groupBy(*KEYS, "path").agg(F.max(F.when(F.col("field") == "title", F.col("value"))).alias("title"), F.max(F.when(F.col("field") == "output", F.col("value"))).alias("out"), F.max(F.when(F.col("field") == "format", F.col("value"))).alias("fmt"))
    who = parse.front_authors(v, KEYS)
    built = files.filter(_is(r"^inst/doc/[^/]+\.(html|pdf)$")).select(*KEYS, F.regexp_replace(basename("path"), r"\.[^.]+$", "").alias("stem")).distinct().withColumn("prebuilt", F.lit(True))
    kept = files.filter(_is(r"^vignettes/.*\.orig$")).select(*KEYS, F.regexp_replace("path", r"\.orig$", "").alias("path")).distinct().withColumn("precomputed", F.lit(True))
    c, ext = F.col("content"), extension("path")
    engine = F.regexp_extract("content", r"%\s*\\VignetteEngine\{([^}]*)\}", 1)
    rows = v.withColumn("stem", F.regexp_replace(basename("path"), r"\.[^.]+$", "")).join(front, [*KEYS, "path"], "left").join(who, [*KEYS, "path"], "left").join(built, [*KEYS, "stem"], "left").join(kept, [*KEYS, "path"], "left")
    said = F.lower(F.concat_ws(" ", "out", "fmt"))
    output = F.when(said.contains("pdf"), "pdf").when(said.contains("html"), "html").when(ext.isin("rnw", "rtex"), "pdf").otherwise("html")
    title = F.coalesce(F.col("title"), F.nullif(F.regexp_extract("content", r"%\s*\\VignetteIndexEntry\{([^}]*)\}", 1), F.lit("")), F.nullif(F.regexp_extract("content", r"\\title\{([^}]*)\}", 1), F.lit("")))
    dynamic = F.when(ext == "rmd", F.regexp_extract_all(c, F.lit(r"```\{r[^}]*\}"), F.lit(0))).otherwise(F.regexp_extract_all(c, F.lit(r"<<[^>]*>>="), F.lit(0)))
    return rows.select(
        *KEYS, F.col("path").alias("file"), ext.alias("format"), F.nullif(engine, F.lit("")).alias("engine"), output.alias("output"), title.alias("title"), "authors", F.size("authors").alias("n_authors"), F.coalesce("stated", F.lit(False)).alias("author_stated"),
        F.nullif(F.regexp_extract(engine, r"^([^:]*)::", 1), F.lit("")).alias("builder"), F.coalesce("prebuilt", F.lit(False)).alias("prebuilt"), F.coalesce("precomputed", F.lit(False)).alias("precomputed"), line_count("content").alias("lines"),
        c.rlike(r"(?m)^\s*```\{[a-zA-Z]|<<[^>]*>>=").alias("has_code"), F.size(dynamic).alias("n_chunks"), F.size(F.filter(dynamic, lambda h: ~h.rlike(r"eval\s*=\s*(FALSE|F)(?=[,}\s]|$)"))).alias("n_active"),
    )


def vignette_metrics(files: DataFrame) -> DataFrame:
    """n_vignettes, has_vignettes, vignette_unrecognised and vignette_dynamic (false only if every chunk
    is switched off)."""
    v = vignettes(files).groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("n_chunks").alias("chunks"), F.sum("n_active").alias("active"))
    odd = files.groupBy(*KEYS).agg(F.count_if(_is("^vignettes/[^/]+$") & ~_is(VIGNETTE)).alias("vignette_unrecognised"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return odd.join(v, KEYS, "left").select(*KEYS, n.alias("n_vignettes"), (n > 0).alias("has_vignettes"), "vignette_unrecognised", F.when(n > 0, (F.col("chunks") == 0) | (F.col("active") > 0)).alias("vignette_dynamic"))


def deprecation_signals(files: DataFrame) -> DataFrame:
    """symbols named in deprecation calls, and whether life-cycle calls are used. Of a life-cycle call the
    second text counts, without a package in front and parentheses behind."""
    # The patterns here are fixed values.
    r = F.when(_is(R_SOURCE), F.col("content")).otherwise("")
    direct = F.regexp_extract_all(r, F.lit(r"\.(?:Deprecated|Defunct)\s*\(\s*[\"']([^\"']+)[\"']"), F.lit(1))
    calls = F.regexp_extract_all(r, F.lit(r"lifecycle::deprecate_(?:warn|soft|stop)\s*\([^,\n]+,\s*[\"'][^\"']+[\"']"), F.lit(0))
    second = F.transform(calls, lambda x: F.get(F.regexp_extract_all(x, F.lit(r"[\"']([^\"']+)[\"']"), F.lit(1)), F.lit(1)))
    bare = F.filter(F.transform(second, lambda x: F.regexp_replace(F.regexp_replace(x, "^[^:]+::", ""), r"\(\)$", "")), lambda x: x != "")
    found = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat(direct, bare)))))
    return files.groupBy(*KEYS).agg(found.alias("symbols"), F.bool_or(r.rlike(r"lifecycle::deprecate_(?:warn|soft|stop)")).alias("uses_lifecycle"))


def archive_fields(files: DataFrame) -> DataFrame:
    """The twelve identity fields of DESCRIPTION files with the digest of their bytes (a column
    content_bytes, where there is one, else the text's)."""
    d = files.filter(_named(["DESCRIPTION"]))
    url = parse.field(parse.fields(d, KEYS), KEYS, "URL").select(*KEYS, blank_to_null(F.trim("URL")).alias("url"))
    own = described(d).select(*KEYS, "title", "description", "authors", "maintainer", "maintainer_email", F.trim("license").alias("license"), "depends", "imports", "suggests", "linkingto", "enhances")
    digest = d.select(*KEYS, F.sha2("content_bytes" if "content_bytes" in files.columns else "content", 256).alias("description_hash"))
    return own.join(url, KEYS, "left").join(digest, KEYS)
