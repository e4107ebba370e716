"""Views of the driver's test tables in the shape of repository exports.

The test tables hold no Git data, so each input table of the library is a
view over them (the same views are written in SQL for the DuckDB oracle in
``__spark_entry__.py``).  Every view reads whole tables; its size grows with
the scale factor.

* commits       <- orders   (sha/seq = o_orderkey, date = o_orderdate,
                             message mentions '#<o_custkey>' and '#<o_orderkey>',
                             first parent = previous order, tree = one of 20 sources)
* commit_files  <- lineitem (a file = a part of an order)
* snapshot_files, blobs <- documents (tree = source, path = doc id + suffix, blob = 'b<doc id>',
                             content = a code-like text derived from the prose)
* file_versions <- conversations (path = conv_id, seq = turn, content = text)
* branchy_commits <- orders  (the same commits as a graph with branches, merges, jumps and clocks that run backwards)
* tree_objects  <- documents (folders that trees share; one root tree per source and language)
* version_log   <- lineitem (path = part, seq = order, a returned part = a deleted file)
* log_points    <- orders, customer (first and last order of a nation's market segment)
* issue_responses <- events (issue = user_id, first two events = attempts)
* issues        <- orders   (closed = status 'F')
* token vectors <- embeddings (vec_id derived from the token)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.embed import VectorLookup
from .parallel import ensure_parallelism

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
N_TREES = 20


# Tables whose rows feed per-row regex work (texts, commit messages): spread when under-split.
# Plain aggregation inputs are not: partial aggregation in one task is cheaper than an extra stage.
REGEX_TABLES = ("documents", "pages", "conversations", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return ensure_parallelism(df) if name in REGEX_TABLES else df


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("sha"),
        F.col("o_orderkey").cast("bigint").alias("seq"),
        F.col("o_orderdate").alias("committed_date"),
        F.concat(F.lit("Fix #"), F.col("o_custkey").cast("string"), F.lit(" ("),
                 F.col("o_orderpriority"), F.lit("), see #"), F.col("o_orderkey").cast("string")).alias("message"),
        F.when(F.col("o_orderkey") > 0, F.array((F.col("o_orderkey") - 1).cast("string")))
        .otherwise(F.array().cast("array<string>")).alias("parents"),
        F.concat(F.lit("src"), (F.col("o_orderkey") % N_TREES).cast("string")).alias("tree"),
        F.col("o_custkey").cast("bigint").alias("issue_id"),
    )


def branchy_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit k has as first parent k - 1, or k div 2 if 64 divides k; every eighth one merges another line.

    Dates grow with k but for a part of a minute and a half.
    """
    k = F.col("o_orderkey").cast("bigint")
    first = F.when(k % 64 == 0, F.floor(k / 2).cast("bigint")).otherwise(k - 1)
    merged = F.floor(k * 5 / 7).cast("bigint")
    parents = F.when(k < 1, F.array().cast("array<string>")).when(
        k % 8 == 3, F.array(first.cast("string"), merged.cast("string"))).otherwise(F.array(first.cast("string")))
    date = F.timestamp_seconds(F.lit(1_600_000_000) + k * 30 + F.col("o_custkey") % 100)
    return table(spark, sf_dir, "orders").select(k.cast("string").alias("sha"), parents.alias("parents"),
                                                 date.alias("committed_date"))


def last_head(commits: DataFrame) -> DataFrame:
    """The head: the commit of the greatest number; commits that only others reach are no part of its log."""
    return commits.agg(F.max(F.col("sha").cast("bigint")).cast("string").alias("sha")).where("sha is not null")


def tree_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root trees per (source, lang) with an own folder and two of 16 shared ones, each of four folders of files."""
    d = code_documents(spark, sf_dir)
    text = lambda *c: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in c])
    name, blob, i = F.element_at(F.split("path", "/"), -1), blob_id(F.col("doc_id")), F.col("doc_id").cast("bigint")
    row = lambda df, tree, name, kind, child: df.select(
        tree.alias("tree_sha"), (name if isinstance(name, Column) else F.lit(name)).alias("name"),
        F.lit(kind).alias("entry_type"), child.alias("child_sha"))
    own = row(d, text("own-", F.col("source"), "-", F.col("lang")), name, "blob", blob)
    leaves = row(d, text("leaf-", (i % 64).cast("string")), name, "blob", blob)
    j = F.col("id")
    mids = [row(spark.range(16), text("mid-", j.cast("string")), folder, "tree", text("leaf-", ((j + 16 * k) % 64).cast("string")))
            for k, folder in ((0, "a"), (1, "b"), (2, "a-c"), (0, "copy"))]
    roots = d.groupBy("source", "lang").agg(F.min(i).alias("m"))
    root = text("root-", F.col("source"), "-", F.col("lang"))
    tops = [row(roots, root, "own", "tree", text("own-", F.col("source"), "-", F.col("lang"))),
            row(roots, root, "lib", "tree", text("mid-", (F.col("m") % 16).cast("string"))),
            row(roots, root, "vendor", "tree", text("mid-", ((F.col("m") + 1) % 16).cast("string"))),
            row(roots, root, "gone", "tree", F.lit("not-here"))]
    out = own
    for part in (leaves, *mids, *tops):
        out = out.unionByName(part)
    return out


def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, seq, blob_sha, deleted): a part's order is a version of a file."""
    li = table(spark, sf_dir, "lineitem")
    # whether the greatest flag is R, from two booleans: a greatest string would need its rows sorted
    flag = F.col("l_returnflag")
    returned = F.max(flag == "R") & ~F.max(flag > "R")
    return (li.groupBy("l_partkey", "l_orderkey")
            .agg(F.max("l_quantity").cast("bigint").alias("_q"), returned.alias("_r"))
            .select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("path"),
                    F.col("l_orderkey").cast("bigint").alias("seq"),
                    F.concat(F.lit("q"), F.col("_q").cast("string")).alias("blob_sha"), F.col("_r").alias("deleted")))


def log_points(spark: SparkSession, sf_dir: str, segments: bool) -> DataFrame:
    """(point_id, query_seq): first and last order of each nation, or of each market segment of a nation."""
    c = table(spark, sf_dir, "customer")
    group = F.concat_ws("-", F.col("c_nationkey").cast("string"), *([F.col("c_mktsegment")] if segments else []))
    owned = table(spark, sf_dir, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), group.alias("g")), "o_custkey")
    ends = owned.groupBy("g").agg(F.min("o_orderkey").cast("bigint").alias("a"), F.max("o_orderkey").cast("bigint").alias("b"))
    pair = F.array(F.struct(F.concat("g", F.lit(":first")).alias("point_id"), F.col("a").alias("query_seq")),
                   F.struct(F.concat("g", F.lit(":last")).alias("point_id"), F.col("b").alias("query_seq")))
    return ends.select(F.inline(pair))


def commit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey", "l_partkey")
            .agg(F.max("l_quantity").cast("bigint").alias("insertions"),
                 F.max("l_linenumber").cast("bigint").alias("deletions"))
            .select(F.col("l_orderkey").cast("string").alias("sha"),
                    F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("path"),
                    "insertions", "deletions"))


def issues_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("issue_id"))


def code_text(text: Column, source: Column, lang: Column) -> Column:
    """Code-like text derived from prose: header comment, import, // and /* */ comments,
    a docstring and an indented trailing comment.  Each line break of the prose begins a function,
    by indentation or by braces, as the language has it."""
    indented = lang.isin("en", "de")
    function = F.when(indented, "\n\ndef g(x):\n    ").otherwise("\n}\nint g(int x)\n{\n")
    comment = F.concat(F.lit(". // "), lang, F.lit("\n"), F.when(indented, "    ").otherwise(""))
    body = F.replace(F.replace(F.replace(text, F.lit("\n"), function), F.lit(". "), comment),
                     F.lit(", "), F.lit(" /* a\n b */ + "))
    return F.concat(F.lit("# "), source, F.lit("\nimport x\n\n"), body,
                    F.lit('\ny = """'), lang, F.lit('\nd"""\n  # end\n'))


def suffix_of(doc_id: Column) -> Column:
    """Suffix of a document's file; varies inside each tree (trees are doc_id mod 20)."""
    m = (doc_id / 20).cast("bigint") % 5
    return (F.when(m == 0, ".py").when(m == 1, ".js").when(m == 2, ".dart").when(m == 3, ".html")
            .otherwise(".md"))


def blob_id(doc_id: Column) -> Column:
    return F.concat(F.lit("b"), doc_id.cast("string"))


def code_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, path, code) -- one code file per document."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", "source", "lang",
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), suffix_of(F.col("doc_id"))).alias("path"),
        code_text(F.col("text"), F.col("source"), F.col("lang")).alias("code"))


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blob entries plus one 'tree' entry (the folder itself) per tree."""
    c = code_documents(spark, sf_dir)
    files = c.select(F.col("source").alias("snapshot_sha"), "path", F.col("doc_id").cast("bigint").alias("seq"),
                     F.lit("blob").alias("entry_type"), blob_id(F.col("doc_id")).alias("blob_sha"))
    folders = (c.groupBy("source").agg(F.min("doc_id").cast("bigint").alias("seq"))
               .select(F.col("source").alias("snapshot_sha"), F.col("source").alias("path"), "seq",
                       F.lit("tree").alias("entry_type"), F.lit(None).cast("string").alias("blob_sha")))
    return files.unionByName(folders)


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One blob per document, keyed like the tree entries (an export's blob table is unique)."""
    c = code_documents(spark, sf_dir)
    return c.select(blob_id(F.col("doc_id")).alias("blob_sha"), F.encode("code", "UTF-8").alias("content"))


def file_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("path"),
        F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("sha"),
        F.col("turn").cast("bigint").alias("seq"),
        F.lit(None).cast("timestamp").alias("committed_date"),
        F.encode("text", "UTF-8").alias("content"))


def _event_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    # every event is an attempt; some raised (NULL status)
    return (e.withColumn("attempt", F.row_number().over(w))
            .withColumn("status", F.when(F.col("event_id") % 7 == 3, F.lit(None).cast("int"))
                        .when(F.col("event_type") == "error", 403)
                        .when(F.col("event_type") == "purchase", 404).otherwise(200)))


def issue_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _event_attempts(spark, sf_dir)
    payload = (F.when(F.col("event_type") == "view", F.col("props"))
               .when(F.col("event_type") == "signup", F.lit('{"body": null}'))
               .otherwise(F.replace(F.col("props"), F.lit('"k"'), F.lit('"body"'))))
    return a.select(F.col("user_id").cast("bigint").alias("issue_id"), F.col("attempt").cast("int"),
                    F.col("status").cast("int"), payload.alias("payload"))


def list_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured 'list closed issues' responses, one request per user."""
    a = _event_attempts(spark, sf_dir)
    number = F.when(F.col("event_id") % 5 == 1, F.lit('"n/a"')).otherwise(F.col("event_id").cast("string"))
    payload = F.concat(F.lit('[{"number": '), number, F.lit("}]"))
    return a.select(F.col("user_id").cast("bigint").alias("request_id"), F.col("attempt").cast("int"),
                    F.col("status").cast("int"), payload.alias("payload"))


def issues_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("bigint").alias("issue_id"),
                    F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("state"),
                    F.col("o_orderdate").alias("created_at"))


def token_lookup(spark: SparkSession, sf_dir: str) -> VectorLookup:
    """vec_id = (ascii(token) * 31 + length(token)) mod (row count of ``embeddings``).

    The row count is a scalar subquery evaluated by Spark, not a literal.
    """
    emb = table(spark, sf_dir, "embeddings")
    n = emb.select(F.count(F.lit(1)).cast("bigint")).scalar()
    key = lambda t: ((F.ascii(t).cast("bigint") * 31 + F.length(t).cast("bigint")) % n)
    return VectorLookup(emb, key_col="vec_id", vec_col="embedding", key_of=key)


def lint_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lint report per source: the lines of its documents."""
    d = table(spark, sf_dir, "documents")
    return d.select("source", F.explode(F.split("text", "\n", -1)).alias("value"))
