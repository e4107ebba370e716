"""Registered queries: one per operator of the inventory, over the driver's tables.

Each entry is ``name -> (spark_query, oracle_sql or None)``.  A Spark query
takes (spark, sf_dir) and returns a lazily planned DataFrame over whole
tables; the SQL computes the same result in DuckDB.  Column names are equal on
both sides; floating-point results are rounded to 6 places on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import text as T
from ..operators import churn as CH
from ..operators import codemetrics as CM
from ..operators import combine as CO
from ..operators import descriptions as DE
from ..operators import duplication as DU
from ..operators import embed as EM
from ..operators import history as HI
from ..operators import linking as LI
from ..operators import sampling as SA
from ..operators import snapshots as SN
from ..operators import treeobjects as TO
from ..operators import versionlog as VL
from ..sources import bindings as B
from ..sources import checkout as CK
from ..sources import sinks as SK
from ..session import ensure_checkpoint_dir
from . import oracle as O
from .dataset import build_issue_dataset

REGISTRY: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _r6(c) -> F.Column:
    return F.round(c.cast("double"), 6)


def _files(spark, d, suffixes) -> DataFrame:
    """Files of every tree (source) with a suffix list: snapshot_sha, path, seq, blob_sha, text."""
    entries = SN.tree_entries(B.snapshot_files(spark, d), suffixes)
    return entries.join(SN.text_blobs(B.blobs(spark, d)), "blob_sha", "inner")


def _file_metrics(spark, d, suffixes=T.CODE_SUFFIXES_BEFORE, hashes: bool = False) -> DataFrame:
    """Per-file metric columns (computed once per distinct blob) joined to the tree entries.

    With ``hashes`` the block hashes come from the same text pass, which ends
    in an exchange that both consumers (metrics, duplication) reuse.
    """
    entries = SN.tree_entries(B.snapshot_files(spark, d), suffixes)
    texts = SN.text_blobs(B.blobs(spark, d))
    if hashes:
        texts = texts.withColumn("hashes", DU.block_hashes(F.col("text"), O.DUP_WINDOW))
    bm = CM.blob_metrics(texts, O.B4_DECISIONS, keep=("hashes",) if hashes else ())
    if hashes:
        bm = bm.repartition("blob_sha")
    return entries.join(bm, "blob_sha", "inner")


def _fmt_ts(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------------------
# Scans and sinks

@register("s1_scan_commits", O.with_(O.V_COMMITS) + """
select sha, seq, strftime(committed_date, '%Y-%m-%d %H:%M:%S') committed_date, message,
       array_to_string(parents, ',') parents, tree from commits""")
def s1(spark, d):
    c = B.commits(spark, d)
    return c.select("sha", "seq", _fmt_ts("committed_date").alias("committed_date"), "message",
                    F.array_join("parents", ",").alias("parents"), "tree")


@register("s1_reachable_log", O.with_recursive(O.V_GRAPH) + """
select cast(k as varchar) sha, cast(row_number() over (order by max(v) desc, cast(k as varchar)) - 1 as bigint) seq
from cd group by k""")
def s1_reachable(spark, d):
    c = B.branchy_commits(spark, d)
    return HI.reachable_log(c, B.last_head(c)).select("sha", "seq")


@register("s2_scan_commit_files", O.with_(O.V_COMMIT_FILES) + "select sha, path, insertions, deletions from commit_files")
def s2(spark, d):
    return B.commit_files(spark, d)


@register("s3_scan_issue_responses", O.with_(O.V_ATTEMPTS, O.V_RESPONSES) +
          "select issue_id, attempt, status, payload from responses")
def s3(spark, d):
    return B.issue_responses(spark, d)


@register("s4_scan_snapshot_files", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS) + """
select s.snapshot_sha, s.path, s.seq, s.entry_type, s.blob_sha, cast(length(b.text) as bigint) n_chars
from snapshot_files s left join blobs b on b.blob_sha = s.blob_sha""")
def s4(spark, d):
    sf = B.snapshot_files(spark, d)
    texts = SN.text_blobs(B.blobs(spark, d)).select("blob_sha", F.length("text").cast("bigint").alias("n_chars"))
    return sf.join(texts, "blob_sha", "left").select("snapshot_sha", "path", "seq", "entry_type", "blob_sha", "n_chars")


@register("s4_scan_checkout", O.with_(O.V_CODE_DOCS) + f"""
select path, cast(row_number() over (order by len(string_split(path, '/')), path) as bigint) seq,
       sha1('blob ' || cast(strlen(code) as varchar) || chr(0) || code) blob_sha, cast(length(code) as bigint) n_chars
from code_docs where {O.suffix_sql('path', T.CODE_SUFFIXES_BEFORE)}""")
def s4_checkout(spark, d):
    """All files are written to a folder and read back from it."""
    folder = ensure_checkpoint_dir(spark).rstrip("/") + f"/checkout-{uuid.uuid4().hex}"
    CK.write_checkout(B.code_documents(spark, d).select("path", F.col("code").alias("text")), folder)
    entries, blobs = CK.scan_checkout(spark, folder, "head", T.CODE_SUFFIXES_BEFORE)
    chars = SN.text_blobs(blobs).select("blob_sha", F.length("text").cast("bigint").alias("n_chars"))
    return entries.join(chars, "blob_sha").select("path", "seq", "blob_sha", "n_chars")


@register("s4_list_tree_objects", O.with_recursive(O.V_CODE_DOCS, O.V_TREE_OBJECTS) + f"""
select root snapshot_sha, path, cast(row_number() over (partition by root order by depth, path) as bigint) seq, blob_sha
from listed where {O.suffix_sql('name', T.CODE_SUFFIXES_BEFORE)}""")
def s4_list(spark, d):
    entries = B.tree_objects(spark, d)
    roots = entries.where("tree_sha like 'root-%'").select("tree_sha")
    return TO.list_trees(entries, roots, T.CODE_SUFFIXES_BEFORE).select("snapshot_sha", "path", "seq", "blob_sha")


@register("s4_tree_object_metrics", O.with_recursive(O.V_CODE_DOCS, O.V_TREE_OBJECTS, O.V_BLOBS) + f""",
measured as (select blob_sha, {O.loc_sql('text')} loc, {O.comments_sql('text')} comments, cast(length(text) as bigint) chars from blobs)
select r.root tree_sha, cast(coalesce(sum(m.loc), 0) as bigint) LOC, cast(coalesce(sum(m.comments), 0) as bigint) Comments,
       cast(count(m.blob_sha) as bigint) n_files, cast(coalesce(sum(m.chars), 0) as bigint) n_chars
from roots r left join listed l on l.root = r.root and {O.suffix_sql('l.name', T.CODE_SUFFIXES_AFTER)}
left join measured m on m.blob_sha = l.blob_sha group by r.root""")
def s4_metrics(spark, d):
    """A7, A8, A17 and A18 of every root tree, from tree objects."""
    measured = CM.blob_metrics(SN.text_blobs(B.blobs(spark, d)), O.B4_DECISIONS)
    trees = TO.tree_metrics(B.tree_objects(spark, d), measured, T.CODE_SUFFIXES_AFTER)
    return trees.where("tree_sha like 'root-%'").select("tree_sha", "LOC", "Comments", "n_files", "n_chars")


def _churn_df(spark, d) -> DataFrame:
    c = B.commits(spark, d).select("issue_id", "sha", "committed_date", "seq")
    return CH.issue_churn(c, B.commit_files(spark, d))


_SINK_SELECT = """
select issue_id, noc NOC, nocf NOCF, noi NOI, nod NOD, first_commit, last_commit, cast(null as varchar) coupling
from churn"""
_SINK_SQL = O.with_(O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS, O.V_CHURN) + _SINK_SELECT


def _sink_roundtrip(spark, d, mode: str) -> DataFrame:
    out = ensure_checkpoint_dir(spark).rstrip("/") + f"/sink-{mode}-{uuid.uuid4().hex}"
    df = _churn_df(spark, d).withColumn("coupling", F.lit(None).cast("double"))
    SK.write_dataset(df, out, mode=mode)
    SK.write_dataset(df, out, mode=mode)
    return spark.read.json(out)


@register("s5_write_dataset_append", _SINK_SQL + "\nunion all" + _SINK_SELECT)
def s5(spark, d):
    return _sink_roundtrip(spark, d, "append")


@register("s5_append_runs", _SINK_SQL + "\nunion all" + _SINK_SELECT)
def s5_runs(spark, d):
    """Run a is written twice and adds its records once; run b adds them again."""
    out = ensure_checkpoint_dir(spark).rstrip("/") + f"/sink-runs-{uuid.uuid4().hex}"
    df = _churn_df(spark, d).withColumn("coupling", F.lit(None).cast("double"))
    for run in ("a", "a", "b"):
        SK.append_run(df, out, run)
    return SK.read_dataset(spark, out)


@register("s6_write_dataset_overwrite", _SINK_SQL)
def s6(spark, d):
    return _sink_roundtrip(spark, d, "overwrite")


@register("s7_scan_lint_lines", """
select source, unnest(string_split(text, chr(10))) value from documents""")
def s7(spark, d):
    return B.lint_lines(spark, d)


@register("s8_combine_files", O.with_(O.V_CODE_DOCS) + f"""
select source, 0 part, '' name, {O.lit(CO.HEADER)} segment from code_docs group by source
union all
select source, 1, path, '# ----- Begin ' || path || ' -----' || chr(10) || code || chr(10) || chr(10) ||
       '# ----- End ' || path || ' -----' || chr(10) || chr(10) from code_docs""")
def s8(spark, d):
    docs = B.code_documents(spark, d)
    return CO.combine_files(docs, "source", "path", "code")


@register("s9_issue_range", O.with_(O.V_ISSUES) + """
select range issue_id from range(1, (select coalesce(arg_max(issue_id, row(created_at, issue_id)), -1)
                                     from issues where state = 'closed') + 1)""")
def s9(spark, d):
    return DE.issue_range(spark, 1, 1, DE.last_closed_issue(B.issues_table(spark, d)))


# ---------------------------------------------------------------------------
# Predicates

@register("p1_references_issue", O.with_(O.V_COMMITS) + """
select sha, contains(message, '#' || cast(issue_id as varchar)) ref_own,
       contains(message, '#' || cast(issue_id // 10 as varchar)) ref_tenth,
       contains(message, '#' || cast(seq % 1000 as varchar)) ref_mod
from commits""")
def p1(spark, d):
    c = B.commits(spark, d)
    return c.select("sha", T.references_issue(F.col("message"), F.col("issue_id")).alias("ref_own"),
                    T.references_issue(F.col("message"), F.floor(F.col("issue_id") / 10)).alias("ref_tenth"),
                    T.references_issue(F.col("message"), F.col("seq") % 1000).alias("ref_mod"))


@register("p2_with_commits", O.with_(O.V_COMMITS) + """
select i.n issue_id from (select cast(c_custkey as bigint) n from customer
                      union all select cast(c_custkey as bigint) + 100000000 from customer) i
where exists (select 1 from commits m where contains(m.message, '#' || cast(i.n as varchar)))""")
def p2(spark, d):
    """Issues are the customers and as many numbers that no commit mentions."""
    customers = B.issues_from_customers(spark, d)
    issues = customers.unionByName(customers.select((F.col("issue_id") + F.lit(100000000)).alias("issue_id")))
    links = LI.link_commits_to_issues(issues, B.commits(spark, d).select("sha", "message"))
    return LI.with_commits(issues, links)


@register("p3_valid_description", O.with_(O.V_ATTEMPTS, O.V_RESPONSES, O.ladder_sql(), O.V_VALID) +
          "select issue_id, issue_description from valid")
def p3(spark, d):
    return DE.valid_description(DE.resolve_descriptions(B.issue_responses(spark, d)))


@register("p4a_is_code_path_before", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES) +
          f"select snapshot_sha, path from snapshot_files where {O.suffix_sql('path', T.CODE_SUFFIXES_BEFORE)}")
def p4a(spark, d):
    return B.snapshot_files(spark, d).where(SN.is_code_path_before(F.col("path"))).select("snapshot_sha", "path")


@register("p4b_is_code_path_after", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES) +
          f"select snapshot_sha, path from snapshot_files where {O.suffix_sql('path', T.CODE_SUFFIXES_AFTER)}")
def p4b(spark, d):
    return B.snapshot_files(spark, d).where(SN.is_code_path_after(F.col("path"))).select("snapshot_sha", "path")


@register("p5_is_text", "select doc_id, doc_id % 7 <> 0 valid_utf8 from documents")
def p5(spark, d):
    """Every seventh document's bytes get a byte that no UTF-8 text has."""
    docs = B.table(spark, d, "documents")
    content = F.encode("text", "UTF-8")
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(content, F.unhex(F.lit("FF")))).otherwise(content)
    return docs.select("doc_id", T.is_text(content).alias("valid_utf8"))


@register("p6_is_blob", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES) +
          "select snapshot_sha, path, blob_sha from snapshot_files where entry_type = 'blob'")
def p6(spark, d):
    return B.snapshot_files(spark, d).where(SN.is_blob("entry_type")).select("snapshot_sha", "path", "blob_sha")


# ---------------------------------------------------------------------------
# Joins

@register("j1_link_commits_to_issues", O.with_(O.V_COMMITS) + """
select cast(c_custkey as bigint) issue_id, sha from customer join commits
  on contains(message, '#' || cast(c_custkey as varchar))""")
def j1(spark, d):
    links = LI.link_commits_to_issues(B.issues_from_customers(spark, d), B.commits(spark, d).select("sha", "message"))
    return links.select("issue_id", "sha")


@register("j2_commit_churn", O.with_(O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS) + """
select c.issue_id, c.sha, cast(coalesce(s.n_files, 0) as bigint) n_files, cast(coalesce(s.ins, 0) as bigint) ins,
       cast(coalesce(s.dels, 0) as bigint) dels
from commits c left join stats s on s.sha = c.sha""")
def j2(spark, d):
    links = B.commits(spark, d).select("issue_id", "sha")
    return CH.commit_churn(links, B.commit_files(spark, d)).select("issue_id", "sha", "n_files", "ins", "dels")


@register("j3_with_description", O.with_(O.V_ATTEMPTS, O.V_RESPONSES, O.ladder_sql(), O.V_VALID) + """
select cast(c_custkey as bigint) issue_id, v.issue_description from customer join valid v on v.issue_id = c_custkey""")
def j3(spark, d):
    return DE.with_description(B.issues_from_customers(spark, d), DE.resolve_descriptions(B.issue_responses(spark, d)))


def _first_last(spark, d) -> DataFrame:
    c = B.commits(spark, d).select("issue_id", "sha", "committed_date", "seq", "parents")
    return CH.issue_churn(c, B.commit_files(spark, d), extra_first=("parents",))


_J45 = O.with_(O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS, O.V_CHURN, O.V_CODE_DOCS, O.V_SNAPSHOT_FILES)


@register("j4_codebase_before", _J45 + f""",
tb as (select ch.issue_id, p.tree snapshot_sha from churn ch join commits f on f.sha = ch.first_commit
       join commits p on len(f.parents) > 0 and p.sha = f.parents[1])
select tb.issue_id, tb.snapshot_sha, s.path, s.blob_sha from tb join snapshot_files s on s.snapshot_sha = tb.snapshot_sha
where s.entry_type = 'blob' and {O.suffix_sql('s.path', T.CODE_SUFFIXES_BEFORE)}""")
def j4(spark, d):
    rows = SN.before_snapshot(_first_last(spark, d), B.commits(spark, d))
    entries = SN.tree_entries(B.snapshot_files(spark, d), T.CODE_SUFFIXES_BEFORE)
    return SN.named_files(rows, entries, "before_snapshot")


@register("j5_codebase_after", _J45 + f""",
ta as (select ch.issue_id, l.tree snapshot_sha from churn ch join commits l on l.sha = ch.last_commit)
select ta.issue_id, ta.snapshot_sha, s.path, s.blob_sha from ta join snapshot_files s on s.snapshot_sha = ta.snapshot_sha
where s.entry_type = 'blob' and {O.suffix_sql('s.path', T.CODE_SUFFIXES_AFTER)}""")
def j5(spark, d):
    rows = SN.after_snapshot(_first_last(spark, d), B.commits(spark, d))
    entries = SN.tree_entries(B.snapshot_files(spark, d), T.CODE_SUFFIXES_AFTER)
    return SN.named_files(rows, entries, "after_snapshot")


def _asof_sql(op: str, shift: int) -> str:
    return O.with_(O.V_VERSIONS) + f"""
select q.path, q.query_seq, arg_max(v.sha, v.seq) sha, max(v.seq) seq
from (select path, seq + {shift} query_seq from versions) q
join versions v on v.path = q.path and v.seq {op} q.query_seq
group by q.path, q.query_seq"""


@register("j6_snapshot_as_of_before", _asof_sql("<", 0))
def j6a(spark, d):
    v = B.file_versions(spark, d)
    q = v.select("path", F.col("seq").alias("query_seq"))
    return SN.versions_as_of(v.select("path", "sha", "seq"), q, inclusive=False).select("path", "query_seq", "sha", "seq")


@register("j6_snapshot_as_of_upto", _asof_sql("<=", 1))
def j6b(spark, d):
    v = B.file_versions(spark, d)
    q = v.select("path", (F.col("seq") + 1).alias("query_seq"))
    return SN.versions_as_of(v.select("path", "sha", "seq"), q, inclusive=True, chunk=2).select(
        "path", "query_seq", "sha", "seq")


def _whole_trees_sql(op: str) -> str:
    return O.with_(O.V_VERSION_LOG, O.v_points(False), O.v_live(op)) + "select point_id, path, blob_sha, seq from live"


@register("j6_whole_trees_before", _whole_trees_sql("<"))
def j6_trees_before(spark, d):
    trees = VL.trees_at(B.version_log(spark, d), B.log_points(spark, d, False), inclusive=False)
    return trees.select("point_id", "path", "blob_sha", "seq")


@register("j6_whole_trees_after", _whole_trees_sql("<="))
def j6_trees_after(spark, d):
    return VL.trees_at(B.version_log(spark, d), B.log_points(spark, d, False)).select("point_id", "path", "blob_sha", "seq")


@register("j9_tree_digests", O.with_(O.V_VERSION_LOG, O.v_points(True), O.v_live("<=")) + """,
hashed as (select point_id, ('0x' || substr(h, 1, 15))::bigint a, ('0x' || substr(h, 16, 15))::bigint b
           from (select point_id, md5(path || chr(0) || blob_sha) h from live))
select p.point_id, cast(count(h.a) as bigint) n_files,
       cast(coalesce(sum(h.a), 0) as varchar) || ':' || cast(coalesce(sum(h.b), 0) as varchar) digest
from points p left join hashed h on h.point_id = p.point_id group by p.point_id""")
def j9_digests(spark, d):
    """Identity of the tree at every point; the SQL lists the trees."""
    return VL.tree_digests(B.version_log(spark, d), B.log_points(spark, d, True)).select("point_id", "n_files", "digest")


@register("j7_file_history", O.with_(O.V_VERSIONS) + "select path, sha, seq from versions")
def j7(spark, d):
    v = B.file_versions(spark, d)
    return SN.file_history(v, v.select("path")).select("path", "sha", "seq")


_PICK_SQL = O.with_(O.V_VERSIONS, f"""picked as (
  select path, arg_min(sha, md5(concat_ws(chr(1), {O.lit(O.SEED)}, path, sha))) sha from versions group by path)""")


@register("j8_file_content_at", _PICK_SQL + """
select p.path, p.sha, v.content from picked p join versions v on v.path = p.path and v.sha = p.sha""")
def j8(spark, d):
    v = B.file_versions(spark, d)
    picks = SA.pick_one(v, ["path"], "sha", seed=O.SEED)
    return SN.file_content_at(v, picks).select("path", "sha", "content")


def _tree_metrics_sql(files_view: str, with_dup: bool = False) -> str:
    """All metrics per tree over a files view (snapshot_sha, path, blob_sha, text)."""
    dup = ""
    if with_dup:
        dup = ", coalesce(dd.dup, 0) CodeDuplication"
    return f"""{O.v_blocks(f'select distinct text t from {files_view}')},
pf as (select snapshot_sha, {O.loc_sql('text')} loc, {O.comments_sql('text')} comments,
              cast(length(text) as bigint) chars, {O.cc_sql('text')} cc, {O.halstead_counts_sql(O.toks_sql('text'))}
       from {files_view}),
pd as (select *, {O.HALSTEAD_DERIVED} from pf),
tm as (select snapshot_sha, cast(sum(loc) as bigint) loc, cast(sum(comments) as bigint) comments, avg(cc) cc,
              cast(count(*) as bigint) n_files, cast(count(cc) as bigint) ccn, cast(sum(chars) as bigint) n_chars,
              cast(sum(cast(hl as bigint)) as bigint) hl, cast(sum(cast(hv as bigint)) as bigint) hv,
              cast(sum({O.trunc_int_sql('hvol')}) as bigint) hvol, cast(sum({O.trunc_int_sql('hdiff')}) as bigint) hdiff,
              cast(sum({O.trunc_int_sql('hdiff * hvol')}) as bigint) heff
       from pd group by snapshot_sha)"""


def _tree_metric_cols(prefix: str = "") -> str:
    return (f"{prefix}loc LOC, {prefix}comments Comments, round({prefix}cc, 6) CyclomaticComplexity, "
            f"{prefix}hl halstead_length, {prefix}hv halstead_vocabulary, {prefix}hvol halstead_volume, "
            f"{prefix}hdiff halstead_difficulty, {prefix}heff halstead_effort, "
            f"round({O.mi_sql(prefix + 'hvol', prefix + 'cc', prefix + 'loc', prefix + 'comments')}, 6) MaintainabilityIndex")


def _spark_metric_cols(m: DataFrame, prefix: str = "") -> list:
    return [F.col(f"{prefix}LOC").alias("LOC"), F.col(f"{prefix}Comments").alias("Comments"),
            _r6(F.col(f"{prefix}CyclomaticComplexity")).alias("CyclomaticComplexity"),
            *[F.col(f"{prefix}HalsteadMetrics.{f}").alias(f) for f in CM.HALSTEAD_FIELDS],
            _r6(F.col(f"{prefix}MaintainabilityIndex")).alias("MaintainabilityIndex")]


_J9_SQL = (O.with_(O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS, O.V_CHURN, O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS,
                   O.V_FILES_BEFORE) + "," + _tree_metrics_sql("files_before") + """,
tb as (select ch.issue_id, p.tree snapshot_sha from churn ch join commits f on f.sha = ch.first_commit
       left join commits p on len(f.parents) > 0 and p.sha = f.parents[1])
select tb.issue_id, coalesce(tm.loc, 0) LOC_before, coalesce(tm.comments, 0) Comments_before,
       round(tm.cc, 6) CyclomaticComplexity_before,
       tm.hvol halstead_volume_before,
       round(""" + O.mi_sql("tm.hvol", "tm.cc", "tm.loc", "tm.comments") + """, 6) MaintainabilityIndex_before
from tb left join tm on tm.snapshot_sha = tb.snapshot_sha""")


@register("j9_attach_metrics", _J9_SQL)
def j9(spark, d):
    rows = SN.before_snapshot(_first_last(spark, d), B.commits(spark, d))
    metrics = CM.all_metrics(_file_metrics(spark, d), ["snapshot_sha"])
    out = CM.attach_metrics(rows.withColumnRenamed("before_snapshot", "snapshot_sha"), metrics, "snapshot_sha", "before",
                            columns=("LOC", "Comments", "CyclomaticComplexity", "HalsteadMetrics",
                                     "MaintainabilityIndex"))
    return out.select("issue_id", "LOC_before", "Comments_before",
                      _r6(F.col("CyclomaticComplexity_before")).alias("CyclomaticComplexity_before"),
                      F.col("HalsteadMetrics_before.halstead_volume").alias("halstead_volume_before"),
                      _r6(F.col("MaintainabilityIndex_before")).alias("MaintainabilityIndex_before"))


# ---------------------------------------------------------------------------
# Aggregations: churn per issue (issue = customer, direct link)

_CHURN_SQL = O.with_(O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS, O.V_CHURN)


@register("a1_noc", _CHURN_SQL + "select issue_id, noc NOC from churn")
def a1(spark, d):
    return _churn_df(spark, d).select("issue_id", "NOC")


@register("a2_nocf", _CHURN_SQL + "select issue_id, nocf NOCF from churn")
def a2(spark, d):
    return _churn_df(spark, d).select("issue_id", "NOCF")


@register("a3_noi", _CHURN_SQL + "select issue_id, noi NOI from churn")
def a3(spark, d):
    return _churn_df(spark, d).select("issue_id", "NOI")


@register("a4_nod", _CHURN_SQL + "select issue_id, nod NOD from churn")
def a4(spark, d):
    return _churn_df(spark, d).select("issue_id", "NOD")


@register("a5_first_commit", _CHURN_SQL + "select issue_id, first_commit from churn")
def a5(spark, d):
    return _churn_df(spark, d).select("issue_id", "first_commit")


@register("a6_last_commit", _CHURN_SQL + "select issue_id, last_commit from churn")
def a6(spark, d):
    return _churn_df(spark, d).select("issue_id", "last_commit")


# Aggregations over codebases (tree = source, 'before' suffix list)

_TREE_SQL = O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE) + "," + _tree_metrics_sql("files_before")


@register("a7_loc_sum", _TREE_SQL + "\nselect snapshot_sha, loc LOC from tm")
def a7(spark, d):
    return CM.loc_sum(_file_metrics(spark, d), ["snapshot_sha"])


@register("a8_comment_sum", _TREE_SQL + "\nselect snapshot_sha, comments Comments from tm")
def a8(spark, d):
    return CM.comment_sum(_file_metrics(spark, d), ["snapshot_sha"])


@register("a9_cyclomatic_mean", _TREE_SQL + "\nselect snapshot_sha, round(cc, 6) CyclomaticComplexity from tm")
def a9(spark, d):
    r = CM.cyclomatic_mean(_file_metrics(spark, d), ["snapshot_sha"])
    return r.select("snapshot_sha", _r6(F.col("CyclomaticComplexity")).alias("CyclomaticComplexity"))


@register("a10_halstead_sums", _TREE_SQL + """
select snapshot_sha, hl halstead_length, hv halstead_vocabulary, hvol halstead_volume, hdiff halstead_difficulty,
       heff halstead_effort from tm""")
def a10(spark, d):
    r = CM.halstead_sums(_file_metrics(spark, d), ["snapshot_sha"])
    return r.select("snapshot_sha", *[F.col(f"HalsteadMetrics.{f}").alias(f) for f in CM.HALSTEAD_FIELDS])


@register("a11_broken_pct", O.with_(
    O.V_CODE_DOCS, O.V_SNAPSHOT_FILES,
    "blobs as (select 'b' || cast(doc_id as varchar) blob_sha, case when doc_id % 9 = 4 then chr(10) || ' ' else code end text from code_docs)",
    O.V_FILES_BEFORE, O.v_blocks("select distinct text t from files_before")) + f""",
pf as (select snapshot_sha, {O.cc_sql('text')} cc, case when cast(substr(blob_sha, 2) as bigint) % 5 <> 3 then {O.toks_sql('text')} end toks
       from files_before)
select snapshot_sha, round(100.0 * count(*) filter (where cc is null) / count(*), 6) broken_pct_complexity,
       round(100.0 * count(*) filter (where toks is null) / count(*), 6) broken_pct_halstead
from pf group by snapshot_sha""")
def a11(spark, d):
    """Every ninth file is blank (no complexity); every fifth has no Halstead figures, as after a failed parse."""
    number = F.substring("blob_sha", 2, 20).cast("bigint")
    blank = F.encode(F.lit("\n "), "UTF-8")
    blobs = B.blobs(spark, d).select("blob_sha", F.when(number % 9 == 4, blank).otherwise(F.col("content")).alias("content"))
    entries = SN.tree_entries(B.snapshot_files(spark, d), T.CODE_SUFFIXES_BEFORE)
    files = entries.join(CM.blob_metrics(SN.text_blobs(blobs), O.B4_DECISIONS), "blob_sha", "inner")
    files = files.withColumn("halstead", F.when(number % 5 != 3, F.col("halstead")))
    r = CM.broken_pct(files, ["snapshot_sha"])
    return r.select("snapshot_sha", _r6(F.col("broken_pct_complexity")).alias("broken_pct_complexity"),
                    _r6(F.col("broken_pct_halstead")).alias("broken_pct_halstead"))


_DUP_SQL = f"""
win as (select snapshot_sha, path, list_filter(list_transform(string_split(text, chr(10)),
                  lambda l: trim(l, ' ' || chr(9) || chr(13))), lambda l: l <> '') ls from files_before),
blk as (select snapshot_sha, md5(array_to_string(ls[i:i + {O.DUP_WINDOW - 1}], chr(10))) h, case when i > 1 then 'x' || ls[i - 1] else '' end prev
        from (select *, unnest(range(1, len(ls) - {O.DUP_WINDOW - 2})) i from win)),
dd as (select snapshot_sha, cast(count(*) filter (where n > 1 and (starts > 0 or lines > 1)) as bigint) dup
       from (select snapshot_sha, h, count(*) n, count(*) filter (where prev = '') starts, count(distinct prev) lines from blk group by all)
       group by snapshot_sha)"""


@register("a12_duplicate_blocks", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE) + "," + _DUP_SQL + """
select t.snapshot_sha, coalesce(dd.dup, 0) CodeDuplication
from (select distinct snapshot_sha from files_before) t left join dd on dd.snapshot_sha = t.snapshot_sha""")
def a12(spark, d):
    entries = SN.tree_entries(B.snapshot_files(spark, d), T.CODE_SUFFIXES_BEFORE)
    hashed = SN.text_blobs(B.blobs(spark, d)).select("blob_sha", DU.block_hashes(F.col("text"), O.DUP_WINDOW).alias("hashes"))
    return DU.duplicate_blocks(entries.join(hashed, "blob_sha", "inner"), ["snapshot_sha"])


@register("a13_lint_count", """
select source, cast(count(*) filter (where contains(value, 'D')) as bigint) CodeDuplication
from (select source, unnest(string_split(text, chr(10))) value from documents) group by source""")
def a13(spark, d):
    return DU.lint_count(B.lint_lines(spark, d), ["source"])


_LEAD_SQL = f"""
ft as (select snapshot_sha, seq, text, len(regexp_extract_all(text, {O.WORDS}, 1)[1:512]) c from files_before),
fo as (select *, coalesce(sum(c) over (partition by snapshot_sha order by seq
                  rows between unbounded preceding and 1 preceding), 0) off from ft where c > 0),
lead as (select * from fo where off < 512)"""


@register("a14_stack_codebase", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE) + """
select snapshot_sha, seq, text, cast(coalesce(sum(length(text)) over (partition by snapshot_sha order by seq
         rows between unbounded preceding and 1 preceding), 0) as bigint) char_offset from files_before""")
def a14(spark, d):
    return EM.stack_codebase(_files(spark, d, T.CODE_SUFFIXES_BEFORE), ["snapshot_sha"])


@register("a15_mean_pool", """
select label, list(m order by dim) embedding from (
  select label, dim, cast(avg(cast(x as double)) as float) m
  from (select label, unnest(embedding) x, unnest(range(len(embedding))) dim from embeddings)
  group by label, dim) group by label""")
def a15(spark, d):
    emb = B.table(spark, d, "embeddings")
    return EM.mean_pool(emb, ["label"], "embedding")


@register("a16_last_closed_issue", O.with_(O.V_ISSUES) + """
select cast(coalesce(arg_max(issue_id, row(created_at, issue_id)), -1) as bigint) last_closed_issue
from issues where state = 'closed'""")
def a16(spark, d):
    return DE.last_closed_issue(B.issues_table(spark, d))


@register("a17_codebase_chars", _TREE_SQL + "\nselect snapshot_sha, n_chars from tm")
def a17(spark, d):
    return CM.codebase_chars(_file_metrics(spark, d), ["snapshot_sha"])


@register("a18_codebase_files", _TREE_SQL + "\nselect snapshot_sha, n_files from tm")
def a18(spark, d):
    return CM.codebase_files_count(_file_metrics(spark, d), ["snapshot_sha"])


@register("a19_all_metrics", _TREE_SQL + "," + _DUP_SQL + "\nselect tm.snapshot_sha, " + _tree_metric_cols("tm.")
          + ", coalesce(dd.dup, 0) CodeDuplication, cast(null as double) Coupling, cast(null as double) Cohesion"
          + "\nfrom tm left join dd on dd.snapshot_sha = tm.snapshot_sha")
def a19(spark, d):
    fm = _file_metrics(spark, d, hashes=True)
    m = CM.all_metrics(fm, ["snapshot_sha"])
    dup = DU.duplicate_blocks(fm, ["snapshot_sha"])
    m = m.join(dup, "snapshot_sha", "left")
    return m.select("snapshot_sha", *_spark_metric_cols(m), "CodeDuplication", "Coupling", "Cohesion")


# ---------------------------------------------------------------------------
# Windows, sorts, sampling

@register("w1_commit_order", O.with_(O.V_COMMITS) + """
select issue_id, sha, cast(row_number() over (partition by issue_id order by committed_date, seq) as bigint) commit_rank
from commits""")
def w1(spark, d):
    return CH.commit_order(B.commits(spark, d).select("issue_id", "sha", "committed_date", "seq")).select(
        "issue_id", "sha", "commit_rank")


@register("w2_pick_one", _PICK_SQL + "\nselect path, sha from picked")
def w2(spark, d):
    return SA.pick_one(B.file_versions(spark, d), ["path"], "sha", seed=O.SEED)


@register("w3_first_tokens", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE) + "," + _LEAD_SQL + f"""
select snapshot_sha, pos, token from (
  select snapshot_sha, off + i - 1 pos, t token
  from (select snapshot_sha, off, unnest(regexp_extract_all(text, {O.WORDS}, 1)[1:512]) t,
               unnest(range(1, 1 + len(regexp_extract_all(text, {O.WORDS}, 1)[1:512]))) i from lead))
where pos < 512""")
def w3(spark, d):
    return EM.first_tokens(_files(spark, d, T.CODE_SUFFIXES_BEFORE), ["snapshot_sha"])


@register("w4_sort_files", O.with_(O.V_CODE_DOCS) + """
select source, path, cast(row_number() over (partition by source order by path) as bigint) file_rank from code_docs""")
def w4(spark, d):
    from ..operators.ranking import rank_within
    docs = B.code_documents(spark, d).select("source", "path")
    return rank_within(docs, ["source"], ["path"], "file_rank").select("source", "path", "file_rank")


# ---------------------------------------------------------------------------
# Scalar functions (per document of the code view unless stated)

@register("f1_loc", O.with_(O.V_CODE_DOCS) + f"select doc_id, {O.loc_sql('code')} loc from code_docs")
def f1(spark, d):
    return B.code_documents(spark, d).select("doc_id", T.loc("code").alias("loc"))


@register("f1_loc_pages", f"select page_id, {O.loc_sql('html')} loc from pages")
def f1p(spark, d):
    return B.table(spark, d, "pages").select("page_id", T.loc("html").alias("loc"))


@register("f2_comment_lines", O.with_(O.V_CODE_DOCS) + f"select doc_id, {O.comments_sql('code')} comments from code_docs")
def f2(spark, d):
    return B.code_documents(spark, d).select("doc_id", T.comment_lines("code").alias("comments"))


@register("f2_comment_lines_pages", f"select page_id, {O.comments_sql('html')} comments_html, "
          f"{O.comments_sql('url')} comments_url from pages")
def f2p(spark, d):
    p = B.table(spark, d, "pages")
    return p.select("page_id", T.comment_lines("html").alias("comments_html"), T.comment_lines("url").alias("comments_url"))


_V_DOC_BLOCKS = O.v_blocks("select distinct code t from code_docs")
_PER_DOC_SQL = O.with_(O.V_CODE_DOCS, _V_DOC_BLOCKS) + f""",
pf as (select doc_id, {O.loc_sql('code')} loc, {O.comments_sql('code')} comments, {O.cc_sql('code')} cc,
              {O.halstead_counts_sql(O.toks_sql('code'))} from code_docs),
pd as (select *, {O.HALSTEAD_DERIVED} from pf)"""


@register("f3_maintainability_index", _PER_DOC_SQL + f"""
select doc_id, round({O.mi_sql('v', 'cc', 'loc', 'comments')}, 6) mi,
       round({O.mi_sql('v * v', '(cc * 10)', 'loc * 50', 'comments')}, 6) mi_large
from (select *, {O.trunc_int_sql('hvol')} v from pd)""")
def f3(spark, d):
    """The index of each file, and that of a file with far larger figures (most small files are clamped to 100)."""
    docs = B.code_documents(spark, d)
    x = docs.select("doc_id", M.file_halstead(F.col("code"))["halstead_volume"].alias("v"),
                    M.lexical_complexity("code", O.B4_DECISIONS).alias("cc"), T.loc("code").alias("loc"),
                    T.comment_lines("code").alias("k"))
    large = M.maintainability_index(F.col("v") * F.col("v"), F.col("cc") * 10, F.col("loc") * 50, F.col("k"))
    return x.select("doc_id", _r6(M.maintainability_index("v", "cc", "loc", "k")).alias("mi"), _r6(large).alias("mi_large"))


@register("f4_halstead", _PER_DOC_SQL + """
select doc_id, h1, h2, n1 "N1", n2 "N2", hl length, hv vocabulary, round(hvol, 6) volume, round(hdiff, 6) difficulty,
       round(hdiff * hvol, 6) effort from pd""")
def f4(spark, d):
    docs = B.code_documents(spark, d)
    tokens = M.let(T.scannable("code"), M.operators_and_operands)
    x = docs.select("doc_id", M.let(tokens, lambda t: M.split_counts(t["ops"], t["opnds"])).alias("c"))
    m = M.halstead_measures(F.col("c.h1"), F.col("c.h2"), F.col("c.N1"), F.col("c.N2"))
    return x.select("doc_id", "c.h1", "c.h2", "c.N1", "c.N2", m["length"].alias("length"),
                    m["vocabulary"].alias("vocabulary"), _r6(m["volume"]).alias("volume"),
                    _r6(m["difficulty"]).alias("difficulty"), _r6(m["effort"]).alias("effort"))


@register("f5_function_complexities", O.with_(O.V_CODE_DOCS, _V_DOC_BLOCKS) + """
select doc_id, array_to_string(coalesce(c.complexities, []), ',') complexities
from code_docs left join (select t, list(cast(complexity as varchar) order by line) complexities from blocks group by t) c on c.t = code""")
def f5_functions(spark, d):
    """The complexity of each function of a file; the SQL finds the functions' line ranges by windows and joins."""
    found = M.function_complexities(T.code_only(T.scannable("code")), O.B4_DECISIONS)
    return B.code_documents(spark, d).select("doc_id", F.array_join(found.cast("array<string>"), ",").alias("complexities"))


@register("f5_block_complexity", O.with_(O.V_CODE_DOCS, _V_DOC_BLOCKS) + f"select doc_id, {O.cc_sql('code')} cc from code_docs")
def f5(spark, d):
    return B.code_documents(spark, d).select("doc_id", M.lexical_complexity("code", O.B4_DECISIONS).alias("cc"))


@register("f6_truncate_int", _PER_DOC_SQL + f"""
select doc_id, {O.trunc_int_sql('hvol')} halstead_volume, {O.trunc_int_sql('hdiff')} halstead_difficulty,
       {O.trunc_int_sql('hdiff * hvol')} halstead_effort from pd""")
def f6(spark, d):
    docs = B.code_documents(spark, d)
    h = M.file_halstead(F.col("code"))
    return docs.select("doc_id", h["halstead_volume"].alias("halstead_volume"),
                       h["halstead_difficulty"].alias("halstead_difficulty"), h["halstead_effort"].alias("halstead_effort"))


@register("f7_has_suffix", O.with_(O.V_CODE_DOCS) + f"""
select path, {O.suffix_sql('path', T.CODE_SUFFIXES_BEFORE)} code_before,
       {O.suffix_sql('path', T.CODE_SUFFIXES_AFTER)} code_after from code_docs""")
def f7(spark, d):
    docs = B.code_documents(spark, d)
    return docs.select("path", T.has_suffix("path", T.CODE_SUFFIXES_BEFORE).alias("code_before"),
                       T.has_suffix("path", T.CODE_SUFFIXES_AFTER).alias("code_after"))


@register("f8_json_body", O.with_(O.V_ATTEMPTS, O.V_RESPONSES) + """
select issue_id, attempt, case when list_contains(json_keys(payload), 'body') then json_extract_string(payload, '$.body')
                               else 'Issue #' || cast(issue_id as varchar) end body
from responses""")
def f8(spark, d):
    r = B.issue_responses(spark, d)
    return r.select("issue_id", "attempt", DE.json_body(F.col("payload"), F.col("issue_id")).alias("body"))


@register("f9_resolve_description", O.with_(O.V_ATTEMPTS, O.V_RESPONSES, O.ladder_sql()) +
          "select issue_id, issue_description from resolved")
def f9(spark, d):
    return DE.resolve_descriptions(B.issue_responses(spark, d))


@register("f10_last_closed_fallback", O.with_(O.V_ATTEMPTS, O.V_LIST_RESPONSES) + """
select request_id, cast(coalesce(case when s1 = 200 then try_cast(json_extract(p1, '$[0].number') as bigint)
                                      when s1 = 403 then case when s2 = 200 then try_cast(json_extract(p2, '$[0].number') as bigint) end
                                 end, -1) as bigint) last_closed_issue
from (select request_id, max(case when attempt = 1 then status end) s1, max(case when attempt = 1 then payload end) p1,
             max(case when attempt = 2 then status end) s2, max(case when attempt = 2 then payload end) p2
      from list_responses group by request_id)""")
def f10(spark, d):
    return DE.resolve_last_closed(B.list_responses(spark, d))


@register("f11_null_placeholders", O.with_(O.V_CODE_DOCS) + """
select source snapshot_sha, cast(null as double) Coupling, cast(null as double) Cohesion from code_docs group by source""")
def f11(spark, d):
    docs = B.code_documents(spark, d).select(F.col("source").alias("snapshot_sha")).distinct()
    return docs.select("snapshot_sha", M.null_placeholder().alias("Coupling"), M.null_placeholder().alias("Cohesion"))


_DESC_VEC_SQL = O.with_(O.V_ATTEMPTS, O.V_RESPONSES, O.ladder_sql(), O.V_VALID, O.V_TOKVEC) + f""",
dt as (select issue_id, unnest(regexp_extract_all(issue_description, {O.WORDS}, 1)[1:512]) tok from valid),
dv as (select dt.issue_id, v.embedding from dt join vecs v on v.vec_id = {O.vec_key_sql('dt.tok')}),
de as (select issue_id, list(m order by dim) embedding from (
         select issue_id, dim, cast(avg(cast(x as double)) as float) m
         from (select issue_id, unnest(embedding) x, unnest(range(len(embedding))) dim from dv)
         group by issue_id, dim) group by issue_id)"""


@register("f12_null_to_empty", _DESC_VEC_SQL + """
select v.issue_id, coalesce(de.embedding, []::float[]) embedding from valid v left join de on de.issue_id = v.issue_id""")
def f12(spark, d):
    valid = DE.valid_description(DE.resolve_descriptions(B.issue_responses(spark, d)))
    vec = EM.embed_texts(valid, ["issue_id"], B.token_lookup(spark, d), "issue_description")
    return valid.join(vec, "issue_id", "left").select("issue_id", M.null_to_empty("embedding").alias("embedding"))


# ---------------------------------------------------------------------------
# Vectors

@register("e1_embed_codebase", O.with_(O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE, O.V_TOKVEC)
          + "," + _LEAD_SQL + f""",
toks as (select snapshot_sha, pos, token from (
  select snapshot_sha, off + i - 1 pos, t token
  from (select snapshot_sha, off, unnest(regexp_extract_all(text, {O.WORDS}, 1)[1:512]) t,
               unnest(range(1, 1 + len(regexp_extract_all(text, {O.WORDS}, 1)[1:512]))) i from lead))
  where pos < 512),
tv as (select t.snapshot_sha, v.embedding from toks t join vecs v on v.vec_id = {O.vec_key_sql('t.token')})
select snapshot_sha, list(m order by dim) embedding from (
  select snapshot_sha, dim, cast(avg(cast(x as double)) as float) m
  from (select snapshot_sha, unnest(embedding) x, unnest(range(len(embedding))) dim from tv)
  group by snapshot_sha, dim) group by snapshot_sha""")
def e1(spark, d):
    return EM.embed_codebase(_files(spark, d, T.CODE_SUFFIXES_BEFORE), ["snapshot_sha"], B.token_lookup(spark, d))


@register("e2_embed_description", _DESC_VEC_SQL + "\nselect issue_id, embedding from de")
def e2(spark, d):
    valid = DE.valid_description(DE.resolve_descriptions(B.issue_responses(spark, d)))
    return EM.embed_texts(valid, ["issue_id"], B.token_lookup(spark, d), "issue_description")


# ---------------------------------------------------------------------------
# The whole dataset

def issue_dataset(spark: SparkSession, d: str) -> DataFrame:
    return build_issue_dataset(B.issues_from_customers(spark, d), B.commits(spark, d), B.commit_files(spark, d),
                               B.snapshot_files(spark, d), B.blobs(spark, d), B.issue_responses(spark, d),
                               B.token_lookup(spark, d))


# A vector as one exact number: its values in thousandths, rounded down, each times its place.
_VEC_SUM_SQL = "cast(sum(cast(floor(cast(m as double) * 1000) as bigint) * (dim + 1)) as bigint)"


def _vec_sum(c) -> F.Column:
    terms = F.transform(c, lambda x, i: F.floor(x.cast("double") * 1000) * (i + 1))
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _p7_sql() -> str:
    from ..functions.metrics import DEFAULT_DECISIONS
    w = O.DUP_WINDOW
    return O.with_(
        O.V_COMMITS, O.V_COMMIT_FILES, O.V_STATS,
        """links as (select cast(c.c_custkey as bigint) issue_id, m.sha, m.committed_date, m.seq, m.parents
  from customer c join commits m on contains(m.message, '#' || cast(c.c_custkey as varchar)))""",
        """churn as (
  select l.issue_id, cast(count(*) as bigint) noc, cast(sum(coalesce(s.n_files, 0)) as bigint) nocf,
         cast(sum(coalesce(s.ins, 0)) as bigint) noi, cast(sum(coalesce(s.dels, 0)) as bigint) nod,
         arg_min(l.sha, row(l.committed_date, l.seq)) first_commit,
         arg_min(l.parents, row(l.committed_date, l.seq)) first_parents,
         arg_max(l.sha, row(l.committed_date, l.seq)) last_commit
  from links l left join stats s on s.sha = l.sha group by l.issue_id)""",
        O.V_ATTEMPTS, O.V_RESPONSES, O.ladder_sql(), O.V_VALID,
        """rws as (
  select ch.*, v.issue_description, p.tree before_snapshot, lc.tree after_snapshot
  from churn ch join valid v on v.issue_id = ch.issue_id
  left join commits p on len(ch.first_parents) > 0 and p.sha = ch.first_parents[1]
  left join commits lc on lc.sha = ch.last_commit)""",
        O.V_CODE_DOCS, O.V_SNAPSHOT_FILES, O.V_BLOBS, O.V_FILES_BEFORE, O.V_FILES_AFTER, O.V_TOKVEC,
        """pf as (select 'before' side, * from files_before union all select 'after' side, * from files_after)""",
        O.v_blocks("select distinct text t from pf", DEFAULT_DECISIONS),
        f"""pm as (select side, snapshot_sha, {O.loc_sql('text')} loc, {O.comments_sql('text')} comments,
              {O.cc_sql('text')} cc, {O.halstead_counts_sql(O.toks_sql('text'))} from pf)""",
        f"""pd as (select *, {O.HALSTEAD_DERIVED} from pm)""",
        f"""tm as (select side, snapshot_sha, cast(sum(loc) as bigint) loc, cast(sum(comments) as bigint) comments,
              avg(cc) cc, cast(sum(cast(hl as bigint)) as bigint) hl, cast(sum(cast(hv as bigint)) as bigint) hv,
              cast(sum({O.trunc_int_sql('hvol')}) as bigint) hvol, cast(sum({O.trunc_int_sql('hdiff')}) as bigint) hdiff,
              cast(sum({O.trunc_int_sql('hdiff * hvol')}) as bigint) heff
       from pd group by side, snapshot_sha)""",
        f"""win as (select side, snapshot_sha, list_filter(list_transform(string_split(text, chr(10)),
                  lambda l: trim(l, ' ' || chr(9) || chr(13))), lambda l: l <> '') ls from pf)""",
        f"""blk as (select side, snapshot_sha, md5(array_to_string(ls[i:i + {w - 1}], chr(10))) h,
                 case when i > 1 then 'x' || ls[i - 1] else '' end prev
        from (select *, unnest(range(1, len(ls) - {w - 2})) i from win))""",
        """dd as (select side, snapshot_sha, cast(count(*) filter (where n > 1 and (starts > 0 or lines > 1)) as bigint) dup
       from (select side, snapshot_sha, h, count(*) n, count(*) filter (where prev = '') starts, count(distinct prev) lines
             from blk group by all) group by side, snapshot_sha)""",
        f"""ft as (select side, snapshot_sha, seq, text, len(regexp_extract_all(text, {O.WORDS}, 1)[1:512]) c from pf)""",
        """fo as (select *, coalesce(sum(c) over (partition by side, snapshot_sha order by seq
                  rows between unbounded preceding and 1 preceding), 0) off from ft where c > 0)""",
        """lead as (select * from fo where off < 512)""",
        f"""ctoks as (select side, snapshot_sha, t from (
  select side, snapshot_sha, off + i - 1 pos, t
  from (select side, snapshot_sha, off, unnest(regexp_extract_all(text, {O.WORDS}, 1)[1:512]) t,
               unnest(range(1, 1 + len(regexp_extract_all(text, {O.WORDS}, 1)[1:512]))) i from lead))
  where pos < 512)""",
        f"""cdim as (select side, snapshot_sha, dim, cast(avg(cast(x as double)) as float) m from (
  select side, snapshot_sha, unnest(v.embedding) x, unnest(range(len(v.embedding))) dim from ctoks t
  join vecs v on v.vec_id = {O.vec_key_sql('t.t')}) group by side, snapshot_sha, dim)""",
        f"""cvec as (select side, snapshot_sha, count(*) n, {_VEC_SUM_SQL} s from cdim group by side, snapshot_sha)""",
        f"""ddim as (select issue_id, dim, cast(avg(cast(x as double)) as float) m from (
  select issue_id, unnest(v.embedding) x, unnest(range(len(v.embedding))) dim from (
    select issue_id, unnest(regexp_extract_all(issue_description, {O.WORDS}, 1)[1:512]) tok from rws) t
  join vecs v on v.vec_id = {O.vec_key_sql('t.tok')}) group by issue_id, dim)""",
        f"""dvec as (select issue_id, count(*) n, {_VEC_SUM_SQL} s from ddim group by issue_id)""",
    ) + """
select r.issue_id, r.issue_description, r.first_commit, r.last_commit, r.noc NOC, r.nocf NOCF, r.noi NOI, r.nod NOD,
  coalesce(b.loc, 0) LOC_before, coalesce(b.comments, 0) Comments_before, coalesce(bd.dup, 0) CodeDuplication_before,
  coalesce(a.loc, 0) LOC_after, coalesce(a.comments, 0) Comments_after, coalesce(ad.dup, 0) CodeDuplication_after,
  round(b.cc, 6) CyclomaticComplexity_before, round(""" + O.mi_sql("b.hvol", "b.cc", "b.loc", "b.comments") + """, 6) MaintainabilityIndex_before,
  round(a.cc, 6) CyclomaticComplexity_after, round(""" + O.mi_sql("a.hvol", "a.cc", "a.loc", "a.comments") + """, 6) MaintainabilityIndex_after,
  b.hl halstead_length_before, b.hv halstead_vocabulary_before, b.hvol halstead_volume_before,
  b.hdiff halstead_difficulty_before, b.heff halstead_effort_before,
  a.hl halstead_length_after, a.hv halstead_vocabulary_after, a.hvol halstead_volume_after,
  a.hdiff halstead_difficulty_after, a.heff halstead_effort_after,
  coalesce(dv.n, 0) desc_dims, coalesce(bv.n, 0) before_dims, coalesce(av.n, 0) after_dims,
  coalesce(dv.s, 0) desc_sum, coalesce(bv.s, 0) before_sum, coalesce(av.s, 0) after_sum
from rws r
left join tm b on b.side = 'before' and b.snapshot_sha = r.before_snapshot
left join dd bd on bd.side = 'before' and bd.snapshot_sha = r.before_snapshot
left join tm a on a.side = 'after' and a.snapshot_sha = r.after_snapshot
left join dd ad on ad.side = 'after' and ad.snapshot_sha = r.after_snapshot
left join cvec bv on bv.side = 'before' and bv.snapshot_sha = r.before_snapshot
left join cvec av on av.side = 'after' and av.snapshot_sha = r.after_snapshot
left join dvec dv on dv.issue_id = r.issue_id"""


@register("p7_issue_dataset", _p7_sql())
def p7(spark, d):
    ds = issue_dataset(spark, d)
    return ds.select(
        "issue_id", "issue_description", "first_commit", "last_commit", "NOC", "NOCF", "NOI", "NOD",
        *[F.col(f"{c}_{s}") for s in ("before", "after") for c in ("LOC", "Comments", "CodeDuplication")],
        *[_r6(F.col(f"{c}_{s}")).alias(f"{c}_{s}") for s in ("before", "after")
          for c in ("CyclomaticComplexity", "MaintainabilityIndex")],
        *[F.col(f"HalsteadMetrics_{s}.{f}").alias(f"{f}_{s}") for s in ("before", "after") for f in CM.HALSTEAD_FIELDS],
        *[f(F.col(c)).cast("bigint").alias(f"{k}_{n}") for n, f in (("dims", F.size), ("sum", _vec_sum))
          for k, c in (("desc", "issue_description_embedding"), ("before", "codebase_embedding_before_first_commit"),
                       ("after", "codebase_embedding_after_last_commit"))],
    )


_TRACKER_SQL = O.with_(
    O.V_COMMITS, O.V_COMMIT_FILES,
    # an issue's number is mentioned where it begins a run of digits behind a #
    """refs as materialized (select distinct sha, substr(d, 1, n) number from (
  select sha, d, unnest(range(1, length(d) + 1)) n from (
    select sha, unnest(regexp_extract_all(message, '#([0-9]+)', 1)) d from commits)))""",
    """links as materialized (select cast(c_custkey as bigint) issue_id, sha
  from customer join refs on number = cast(c_custkey as varchar))""",
    f"""pc as materialized (select issue_id, arg_min(sha, md5(concat_ws(chr(1), {O.lit(O.SEED)}, cast(issue_id as varchar), sha))) sha
  from links group by issue_id)""",
    f"""pf as materialized (select pc.issue_id, arg_min(cf.path, md5(concat_ws(chr(1), {O.lit(O.SEED)}, cast(pc.issue_id as varchar),
  cf.path))) path from pc join commit_files cf on cf.sha = pc.sha group by pc.issue_id)""",
    """numbered as materialized (select path, sha, count(*) over (partition by path) n,
  row_number() over (partition by path order by sha) k from commit_files)""",
    f"""drawn as (select distinct pf.issue_id, pf.path, n,
  1 + cast('0x' || substr(md5(concat_ws(chr(1), {O.lit(O.SEED)}, cast(issue_id as varchar), pf.path)), 1, 15) as bigint) % n k
  from pf join numbered on numbered.path = pf.path)""",
) + """
select pc.issue_id, pc.sha commit_sha, d.path file_path, r.sha revision_sha, cast(d.n as bigint) n_history
from pc join drawn d on d.issue_id = pc.issue_id join numbered r on r.path = d.path and r.k = d.k"""


@register("e3_issue_change_tracker", _TRACKER_SQL)
def e3(spark, d):
    from .tracker import track_issue_changes
    return track_issue_changes(B.issues_from_customers(spark, d), B.commits(spark, d), B.commit_files(spark, d),
                               seed=O.SEED)
