"""DuckDB SQL for every registered query (the correctness oracle).

Each query is written from scratch in SQL over the driver's tables: the same
views as :mod:`issuelens.sources.bindings`, then the operator's semantics.
Regular expressions are shared with the Spark side (they are written for both
Java's engine and RE2).  Floating-point results are rounded to 6 places on
both sides; Spark's half-even rounding of the shortest decimal form is
mirrored by rounding a decimal cast of the value's text.
"""

from __future__ import annotations

from ..functions.text import (BLANK_LINE_CHARS, CODE_SUFFIXES_AFTER, CODE_SUFFIXES_BEFORE, COMMENT, CONTROL_LINE, ESCAPES,
                              FUNCTION_LINE, HANGING_BRACE, LEX_TOKEN, LINE_SEP_CHARS, LOC_STRIP_RE2, NON_WS, OPERATOR_START,
                              SCAN, WORD_TOKEN)

B4_DECISIONS = ("and", "or", "for", "if", "the")
DUP_WINDOW = 4
SEED = "0"


def lit(s: str) -> str:
    """A SQL string literal (no escape processing in DuckDB)."""
    return "'" + s.replace("'", "''") + "'"


def suffix_sql(col: str, suffixes) -> str:
    return "(" + " or ".join(f"ends_with({col}, {lit(s)})" for s in suffixes) + ")"


def loc_sql(col: str) -> str:
    cleaned = f"regexp_replace({col}, {lit(LOC_STRIP_RE2)}, '', 'g')"
    return (f"cast(len(list_filter(string_split_regex({cleaned}, {lit('[' + LINE_SEP_CHARS + ']')}), "
            f"lambda l: regexp_matches(l, {lit(NON_WS)}))) as bigint)")


def comments_sql(col: str) -> str:
    return (f"cast(coalesce(list_sum(list_transform(regexp_extract_all({col}, {lit(COMMENT)}, 1), "
            f"lambda m: len(string_split(m, chr(10))))), 0) as bigint)")


def scannable_sql(col: str) -> str:
    for seen, instead in ESCAPES:
        col = f"replace({col}, {lit(seen)}, {lit(instead)})"
    return col


def code_sql(col: str) -> str:
    return f"regexp_replace({scannable_sql(col)}, {lit(SCAN)}, ' ', 'g')"


def toks_sql(col: str) -> str:
    """Tokens outside comments and strings, then the string literals."""
    strings = f"list_filter(regexp_extract_all({scannable_sql(col)}, {lit(SCAN)}, 1), lambda s: s <> '')"
    return f"list_concat(regexp_extract_all({code_sql(col)}, {lit(LEX_TOKEN)}, 1), {strings})"


def bround_sql(x: str, d: int = 2) -> str:
    """Spark's bround on a double: half-even on the shortest decimal form."""
    return f"cast(round_even(cast(cast({x} as varchar) as decimal(38,18)), {d}) as double)"


def v_blocks(of: str, decisions=B4_DECISIONS) -> str:
    """blocks(t, line, complexity): every function of the texts ``of`` (a query of one column t).

    Functions are found by their line ranges: a function line reaches up to the next line that is not deeper;
    those inside another's range are counted there.
    """
    dec = "[" + ", ".join(lit(d) for d in decisions) + "]"
    return f"""texts as ({of}),
lns as (select t, unnest(ls) l, generate_subscripts(ls, 1) i from (select t, list_filter(string_split(
  regexp_replace({code_sql('t')}, {lit(HANGING_BRACE)}, ') {{', 'g'), chr(10)), lambda l: regexp_matches(l, {lit(BLANK_LINE_CHARS)})) ls from texts)),
feat as (select t, i, length(replace(l, '}}', '')) - length(replace(l, '{{', '')) braces,
  length(regexp_extract(l, '^([ \\t]*)', 1)) indent,
  case when regexp_matches(l, '^[ \\t]*\\{{') then 1 else 0 end - length(regexp_extract(l, '^[ \\t]*(\\}}*)', 1)) lead,
  regexp_matches(l, {lit(FUNCTION_LINE)}) and not regexp_matches(l, {lit(CONTROL_LINE)}) opens,
  len(list_filter(regexp_extract_all(l, {lit(LEX_TOKEN)}, 1), lambda x: list_contains({dec}, x))) hits from lns),
deep as (select *, lead + coalesce(sum(braces) over (partition by t order by i rows between unbounded preceding and 1 preceding), 0) d from feat),
spans as (select h.t, h.i, h.hits, (select min(n.i) from deep n where n.t = h.t and n.i > h.i
  and (n.d < h.d or n.d = h.d and n.indent <= h.indent)) e from deep h where h.opens),
tops as (select * from spans s where not exists (
  select 1 from spans o where o.t = s.t and o.i < s.i and (o.e is null or s.i < o.e))),
blocks as (select s.t, s.i line, 1 + sum(n.hits) + count(*) filter (where n.opens and n.i > s.i) complexity
  from tops s join deep n on n.t = s.t and n.i >= s.i and (s.e is null or n.i < s.e) group by s.t, s.i),
cc_of as (select t, {bround_sql('cast(sum(complexity) as double) / count(*)')} cc from blocks group by t)"""


def cc_sql(col: str) -> str:
    """The mean complexity of a text among those of :func:`v_blocks`."""
    return f"(select c.cc from cc_of c where c.t = {col})"


def halstead_counts_sql(col: str) -> str:
    """h1, h2, N1, N2 columns (as a select list fragment) from the token list ``col``."""
    ops = f"list_filter({col}, lambda t: regexp_matches(t, {lit(OPERATOR_START)}))"
    ods = f"list_filter({col}, lambda t: not regexp_matches(t, {lit(OPERATOR_START)}))"
    return (f"cast(len(list_distinct({ops})) as bigint) h1, cast(len(list_distinct({ods})) as bigint) h2, "
            f"cast(len({ops}) as bigint) n1, cast(len({ods}) as bigint) n2")


HALSTEAD_DERIVED = """
  cast(n1 + n2 as double) hl, cast(h1 + h2 as double) hv,
  case when h1 + h2 > 0 then (n1 + n2) * (ln(h1 + h2) / ln(2)) else 0.0 end hvol,
  case when h2 > 0 then (h1 * n2) / (2.0 * h2) else 0.0 end hdiff"""


def trunc_int_sql(x: str) -> str:
    return f"cast(trunc({bround_sql(x)}) as bigint)"


def mi_sql(v: str, cc: str, s: str, k: str) -> str:
    raw = (f"(171 * 1.8 - 5.2 * ln({v}) - 0.23 * ({cc}) - 16.2 * ln({s}) "
           f"+ 50.0 * sin(sqrt(2.46 * radians({k}))))")
    return (f"(case when {v} is null then null when {v} <= 0 or {s} <= 0 then 100.0 "
            f"when ({cc}) is null then null else least(greatest(0.0, {raw} * 100.0 / 171.0), 100.0) end)")


# ---------------------------------------------------------------------------
# Views of the driver tables (same as the Spark bindings).

V_COMMITS = """commits as (
  select cast(o_orderkey as varchar) sha, cast(o_orderkey as bigint) seq, o_orderdate committed_date,
         'Fix #' || cast(o_custkey as varchar) || ' (' || o_orderpriority || '), see #' || cast(o_orderkey as varchar) message,
         case when o_orderkey > 0 then [cast(o_orderkey - 1 as varchar)] else []::varchar[] end parents,
         'src' || cast(o_orderkey % 20 as varchar) tree,
         cast(o_custkey as bigint) issue_id
  from orders)"""

V_GRAPH = """graph as (
  select k, case when k < 1 then [] when k % 8 = 3 then [first, k * 5 // 7] else [first] end parents,
         1600000000 + k * 30 + o_custkey % 100 date
  from (select cast(o_orderkey as bigint) k, o_custkey,
               cast(case when o_orderkey % 64 = 0 then o_orderkey // 2 else o_orderkey - 1 end as bigint) first from orders)),
link as (select k, p from (select k, unnest(parents) p from graph) where p in (select k from graph)),
reached(k) as (select max(k) from graph having count(*) > 0 union select l.p from reached r join link l on l.k = r.k),
cd(k, v) as (
  select k, date from graph semi join reached using (k)
  union select l.k, cd.v + 1 from cd join link l on l.p = cd.k join graph g on g.k = l.k semi join reached r on r.k = l.k
  where cd.v + 1 > g.date)"""

V_TREE_OBJECTS = """named as (select *, split_part(path, '/', -1) name, 'b' || cast(doc_id as varchar) blob from code_docs),
roots as (select 'root-' || source || '-' || lang root, source, lang, min(doc_id) m from code_docs group by source, lang),
entries as (
  select 'own-' || source || '-' || lang tree, name, 'blob' kind, blob child from named
  union all select 'leaf-' || cast(doc_id % 64 as varchar), name, 'blob', blob from named
  union all select 'mid-' || cast(j as varchar), f.n, 'tree', 'leaf-' || cast((j + 16 * f.k) % 64 as varchar)
    from range(16) t(j), (values (0, 'a'), (1, 'b'), (2, 'a-c'), (0, 'copy')) f(k, n)
  union all select root, 'own', 'tree', 'own-' || source || '-' || lang from roots
  union all select root, 'lib', 'tree', 'mid-' || cast(m % 16 as varchar) from roots
  union all select root, 'vendor', 'tree', 'mid-' || cast((m + 1) % 16 as varchar) from roots
  union all select root, 'gone', 'tree', 'not-here' from roots),
opened(root, tree, prefix, depth) as (
  select root, root, '', 0 from roots
  union all select o.root, e.child, o.prefix || e.name || '/', o.depth + 1 from opened o join entries e on e.tree = o.tree where e.kind = 'tree'),
listed as (select o.root, o.prefix || e.name path, o.depth, e.name, e.child blob_sha
           from opened o join entries e on e.tree = o.tree where e.kind = 'blob')"""

V_VERSION_LOG = """log as (
  select 'p' || cast(l_partkey as varchar) path, cast(l_orderkey as bigint) seq,
         'q' || cast(cast(trunc(max(l_quantity)) as bigint) as varchar) blob_sha, max(l_returnflag) = 'R' deleted
  from lineitem group by l_partkey, l_orderkey)"""


def v_points(segments: bool) -> str:
    g = "cast(c_nationkey as varchar)" + (" || '-' || c_mktsegment" if segments else "")
    return f"""ends as (select {g} g, min(o_orderkey) a, max(o_orderkey) b from orders join customer on c_custkey = o_custkey group by 1),
points as (select g || ':first' point_id, cast(a as bigint) query_seq from ends
           union all select g || ':last', cast(b as bigint) from ends)"""


def v_live(op: str) -> str:
    """Files of every point's tree, each tree listed by itself."""
    return f"""newest as (
  select p.point_id, p.query_seq, v.path, arg_max(v.blob_sha, v.seq) blob_sha, max(v.seq) seq, arg_max(v.deleted, v.seq) deleted
  from points p join log v on v.seq {op} p.query_seq group by 1, 2, 3),
live as (select * from newest where not deleted)"""


V_COMMIT_FILES = """commit_files as (
  select cast(l_orderkey as varchar) sha, 'p' || cast(l_partkey as varchar) path,
         cast(trunc(max(l_quantity)) as bigint) insertions, cast(max(l_linenumber) as bigint) deletions
  from lineitem group by l_orderkey, l_partkey)"""

V_CODE_DOCS = """code_docs as (
  select doc_id, source, lang,
    source || '/' || cast(doc_id as varchar) ||
      case (doc_id // 20) % 5 when 0 then '.py' when 1 then '.js' when 2 then '.dart' when 3 then '.html' else '.md' end path,
    '# ' || source || chr(10) || 'import x' || chr(10) || chr(10) ||
      replace(replace(replace(text, chr(10), case when lang in ('en', 'de') then chr(10) || chr(10) || 'def g(x):' || chr(10) || '    '
                                             else chr(10) || '}' || chr(10) || 'int g(int x)' || chr(10) || '{' || chr(10) end),
                      '. ', '. // ' || lang || chr(10) || case when lang in ('en', 'de') then '    ' else '' end),
              ', ', ' /* a' || chr(10) || ' b */ + ') ||
      chr(10) || 'y = ' || repeat(chr(34), 3) || lang || chr(10) || 'd' || repeat(chr(34), 3) ||
      chr(10) || '  # end' || chr(10) code
  from documents)"""

V_SNAPSHOT_FILES = """snapshot_files as (
  select source snapshot_sha, path, cast(doc_id as bigint) seq, 'blob' entry_type, 'b' || cast(doc_id as varchar) blob_sha
  from code_docs
  union all
  select source, source, cast(min(doc_id) as bigint), 'tree', cast(null as varchar) from code_docs group by source)"""

V_BLOBS = """blobs as (select 'b' || cast(doc_id as varchar) blob_sha, code text from code_docs)"""


def v_files(name: str, suffixes) -> str:
    """Files of every tree with the given suffix list: (snapshot_sha, path, seq, blob_sha, text)."""
    return (f"{name} as (select s.snapshot_sha, s.path, s.seq, s.blob_sha, b.text from snapshot_files s "
            f"join blobs b on b.blob_sha = s.blob_sha where s.entry_type = 'blob' and {suffix_sql('s.path', suffixes)})")


V_FILES_BEFORE = v_files("files_before", CODE_SUFFIXES_BEFORE)
V_FILES_AFTER = v_files("files_after", CODE_SUFFIXES_AFTER)

V_VERSIONS = """versions as (
  select cast(conv_id as varchar) path, cast(conv_id as varchar) || ':' || cast(turn as varchar) sha,
         cast(turn as bigint) seq, text content
  from conversations)"""

V_ATTEMPTS = """attempts as (
  select *, case when event_id % 7 = 3 then null when event_type = 'error' then 403
                 when event_type = 'purchase' then 404 else 200 end status
  from (select *, row_number() over (partition by user_id order by ts, event_id) attempt from events))"""

V_RESPONSES = """responses as (
  select cast(user_id as bigint) issue_id, cast(attempt as integer) attempt, cast(status as integer) status,
         case event_type when 'view' then props when 'signup' then '{"body": null}'
              else replace(props, '"k"', '"body"') end payload
  from attempts)"""

V_LIST_RESPONSES = """list_responses as (
  select cast(user_id as bigint) request_id, cast(attempt as integer) attempt, cast(status as integer) status,
         '[{"number": ' || case when event_id % 5 = 1 then '"n/a"' else cast(event_id as varchar) end || '}]' payload
  from attempts)"""

V_ISSUES = """issues as (
  select cast(o_orderkey as bigint) issue_id, case when o_orderstatus = 'F' then 'closed' else 'open' end state,
         o_orderdate created_at from orders)"""

V_STATS = """stats as (
  select sha, count(*) n_files, sum(coalesce(insertions, 0)) ins, sum(coalesce(deletions, 0)) dels
  from commit_files group by sha)"""

V_CHURN = """churn as (
  select c.issue_id, cast(count(*) as bigint) noc, cast(sum(coalesce(s.n_files, 0)) as bigint) nocf,
         cast(sum(coalesce(s.ins, 0)) as bigint) noi, cast(sum(coalesce(s.dels, 0)) as bigint) nod,
         arg_min(c.sha, row(c.committed_date, c.seq)) first_commit,
         arg_max(c.sha, row(c.committed_date, c.seq)) last_commit
  from commits c left join stats s on s.sha = c.sha group by c.issue_id)"""


def ladder_sql() -> str:
    """F9 over ``responses``: (issue_id, issue_description)."""
    def body(p):
        keys = f"json_keys({p})"
        return (f"case when not json_valid({p}) or json_type({p}) <> 'OBJECT' then "
                f"'Issue #' || cast(issue_id as varchar) || ' (error fetching description)' "
                f"when list_contains({keys}, 'body') then json_extract_string({p}, '$.body') "
                f"else 'Issue #' || cast(issue_id as varchar) end")
    return f"""resolved as (
  select issue_id,
    case when s1 is null then 'Issue #' || cast(issue_id as varchar) || ' (error fetching description)'
         when s1 = 200 then {body('p1')}
         when s1 = 403 then case when s2 = 200 then {body('p2')}
           when n2 > 0 and s2 is null then 'Issue #' || cast(issue_id as varchar) || ' (error fetching description)' end
         else 'Issue #' || cast(issue_id as varchar) || ' (not found)' end issue_description
  from (select issue_id,
          max(case when attempt = 1 then status end) s1, max(case when attempt = 1 then payload end) p1,
          max(case when attempt = 2 then status end) s2, max(case when attempt = 2 then payload end) p2,
          count(*) filter (where attempt = 2) n2
        from responses group by issue_id))"""


V_VALID = """valid as (
  select * from resolved where issue_description is not null and issue_description <> ''
    and not contains(issue_description, '(not found)')
    and not contains(issue_description, '(error fetching description)'))"""

V_TOKVEC = """vecs as (select vec_id, embedding from embeddings),
  nvec as (select count(*) n from embeddings)"""


def vec_key_sql(tok: str) -> str:
    return f"((ascii({tok}) * 31 + length({tok})) % (select n from nvec))"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def with_recursive(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


WORDS = lit(WORD_TOKEN)
