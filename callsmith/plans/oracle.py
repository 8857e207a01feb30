"""DuckDB SQL equal in meaning to each registered query.

Dialect notes: RE2 has no back-references and its ``\\s``/``\\d``/``\\w`` are
ASCII, so a pattern with ``(['"])…\\1`` becomes one pattern per quote kind and
name classes are spelled ``[\\p{L}\\p{N}_]``; DuckDB rounds a double cast to
int, so ``trunc`` comes first; list lambdas use ``lambda x, i: …`` with
1-based indexes.
"""

from __future__ import annotations

from callsmith import fixed

ORACLE: dict[str, str] = {}


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


NUM = q(fixed.NUMBER_PATTERN)
ANY_QUOTED = q(fixed.ANY_QUOTED)
# Python's str.strip() whitespace set (every code point whose isspace() is true).
_PY_WS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WS = q(_PY_WS)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def int_text(x: str) -> str:
    return f"CAST(CAST(trunc({x}) AS INTEGER) AS VARCHAR)"


def dec_text(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR)"


def sum_prompt(a: str, b: str) -> str:
    return f"'What is the sum of ' || {int_text(a)} || ' and ' || CAST({b} AS VARCHAR) || '?'"


def first_match(text: str, pattern: str, group: int) -> str:
    return f"CASE WHEN regexp_matches({text}, {q(pattern)}) THEN regexp_extract({text}, {q(pattern)}, {group}) END"


def distinct_in_order(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


# --- RE2 forms of the extraction patterns ------------------------------------
SUB_IN_WITH_1 = r"(?i)in\s+(?:the\s+)?(?:string\s+)?'(.*?)'\s+with"
SUB_IN_WITH_2 = r'(?i)in\s+(?:the\s+)?(?:string\s+)?"(.*?)"\s+with'
SUB_WITH_IN_1 = r"""(?i)with\s+['"][^'"]+['"]\s+in\s+'(.*?)'"""
SUB_WITH_IN_2 = r"""(?i)with\s+['"][^'"]+['"]\s+in\s+"(.*?)\""""
WORD_RE = r"""(?i)word\s+['"]([\p{L}\p{N}_]+)['"]"""
REPL_RE = "(?i)" + fixed.REPLACEMENT_IN_QUOTES
PAIR_VERB = "(?i)" + fixed.PAIR_AFTER_VERB
PAIR_ANY = "(?i)" + fixed.PAIR_ANYWHERE
GREET_RE = r"(?i)greet\s+([\p{L}\p{N}_\-]+)"


def sub_source(p: str) -> str:
    return (f"coalesce({first_match(p, SUB_IN_WITH_1, 1)}, {first_match(p, SUB_IN_WITH_2, 1)}, "
            f"{first_match(p, SUB_WITH_IN_1, 1)}, {first_match(p, SUB_WITH_IN_2, 1)})")


def contains_any(low: str, words) -> str:
    return "(" + " OR ".join(f"contains({low}, {q(w)})" for w in words) + ")"


def sub_regex(p: str) -> str:
    low = f"lower({p})"
    parts = [f"WHEN {contains_any(low, ws)} THEN {q(rx)}" for ws, rx in fixed.PATTERN_PHRASES]
    word = first_match(p, WORD_RE, 1)
    parts.append(f"WHEN contains({low}, 'word') THEN '\\b' || {word} || '\\b'")
    return "CASE " + " ".join(parts) + " END"


def sub_repl(p: str) -> str:
    low = f"lower({p})"
    parts = [f"WHEN regexp_matches({p}, {q(REPL_RE)}) THEN regexp_extract({p}, {q(REPL_RE)}, 1)"]
    parts += [f"WHEN {contains_any(low, ws)} THEN {q(r)}" for ws, r in fixed.REPLACEMENT_PHRASES]
    return "CASE " + " ".join(parts) + " END"


def pair(p: str, which: int) -> str:
    return (f"coalesce({first_match(p, PAIR_VERB, which)}, {first_match(p, PAIR_ANY, which)}, "
            f"regexp_extract_all({p}, {ANY_QUOTED}, 1)[{which}])")


def quoted_all(p: str) -> str:
    return (f"list_concat(regexp_extract_all({p}, {q(fixed.SINGLE_QUOTED)}, 1), "
            f"regexp_extract_all({p}, {q(fixed.DOUBLE_QUOTED)}, 1))")


def longest(lst: str) -> str:
    return f"list_reduce({lst}, lambda a, x: CASE WHEN length(x) > length(a) THEN x ELSE a END, '')"


def greet(p: str) -> str:
    return first_match(p, GREET_RE, 1)


def py_int(v: str) -> str:
    """int(float(v)) for a number text matched by the number pattern; '' → 0."""
    return f"CASE WHEN {v} = '' THEN 0 ELSE CAST(trunc(CAST({v} AS DOUBLE)) AS BIGINT) END"


def py_float(v: str) -> str:
    return f"CASE WHEN {v} = '' THEN 0.0 ELSE CAST({v} AS DOUBLE) END"


# --- request templates (same text as callsmith.sources.requests) ---------------

def substitute_prompt() -> str:
    return """CASE p_partkey % 5
  WHEN 0 THEN 'Replace all vowels in ''' || p_name || ''' with asterisks'
  WHEN 1 THEN 'Substitute the word ''' || split_part(p_name, ' ', 1) || ''' with ''' || p_brand
              || ''' in ''' || p_name || ''''
  WHEN 2 THEN 'Replace consonants in ''' || p_name || ''' with underscores'
  WHEN 3 THEN 'Substitute spaces in ''' || p_name || ''' with nothing'
  ELSE 'Substitute the digits in the string ''' || p_type || ' ' || CAST(p_size AS VARCHAR)
       || ''' with ''' || p_brand || ''''
END"""


def part_prompt() -> str:
    return """CASE p_partkey % 5
  WHEN 0 THEN 'Reverse the string ''' || p_name || ''''
  WHEN 1 THEN 'Replace all vowels in ''' || p_name || ''' with asterisks'
  WHEN 2 THEN 'Concatenate ''' || p_name || ''' and ''' || p_brand || ''''
  WHEN 3 THEN 'Is ' || CAST(p_size AS VARCHAR) || ' an even number?'
  ELSE 'Substitute the word ''' || split_part(p_name, ' ', 1) || ''' with ''' || p_type
       || ''' in ''' || p_name || ''''
END"""


def pair_prompt() -> str:
    return """CASE p_partkey % 3
  WHEN 0 THEN 'Concatenate ''' || p_name || ''' and ''' || p_brand || ''''
  WHEN 1 THEN 'Please put ''' || p_name || ''' with ''' || p_type || ''' together'
  ELSE 'Glue ''' || p_brand || ''' onto ''' || p_name || ''''
END"""


MIXED_REQUESTS = f"""
  SELECT 'lineitem' AS src, CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS key,
         {sum_prompt('l_quantity', 'l_linenumber')} AS prompt FROM lineitem
  UNION ALL
  SELECT 'orders', CAST(o_orderkey AS BIGINT), 'Find the max of ' || CAST(o_custkey % 10 AS VARCHAR)
         || ' and ' || CAST(o_orderkey % 10 AS VARCHAR) FROM orders
  UNION ALL
  SELECT 'part', CAST(p_partkey AS BIGINT), {part_prompt()} FROM part
  UNION ALL
  SELECT 'nation', CAST(n_nationkey AS BIGINT), 'Greet ' || n_name FROM nation
  UNION ALL
  SELECT 'customer', CAST(c_custkey AS BIGINT), 'Greet ' || c_name FROM customer
  UNION ALL
  SELECT 'supplier', CAST(s_suppkey AS BIGINT), 'What is the absolute value of ' || {dec_text('s_acctbal')}
         FROM supplier
  UNION ALL
  SELECT 'conversations', CAST(conv_id * 1000 + turn AS BIGINT), text FROM conversations
"""


def _keywords() -> list[tuple[int, str, list[str]]]:
    out = []
    for i, (name, _args, _ret) in enumerate(fixed.REFERENCE_CATALOG):
        kws = {p for p in name.split("_") if p and p not in fixed.KEYWORD_STOPWORDS}
        kws |= set(fixed.KEYWORD_ALIASES.get(name, ()))
        out.append((i, name, sorted(kws)))
    return out


CATALOG_KEYWORDS = "VALUES " + ", ".join(
    f"({i}, {q(n)}, [{', '.join(q(k) for k in kws)}])" for i, n, kws in _keywords())

ARG_SPECS = "VALUES " + ", ".join(
    f"({q(n)}, {j}, {q(a)}, {q(t)})"
    for n, args, _r in fixed.REFERENCE_CATALOG for j, (a, t) in enumerate(args))

CATALOG_LIST = "[" + ", ".join(
    f"{{'ord': {i}, 'fn_name': {q(n)}, 'kws': [{', '.join(q(k) for k in kws)}]}}"
    for i, n, kws in _keywords()) + "]"

NUMERIC_ARG_COUNTS = "VALUES " + ", ".join(
    f"({q(n)}, {sum(t in ('int', 'float') for _, t in args)})" for n, args, _r in fixed.REFERENCE_CATALOG)


def selected(req_sql: str) -> str:
    """CTEs ending in ``sel(src, key, prompt, fn_name, fn_score)``: the lexical scorer.

    The argmax is taken in-row (first maximum in catalogue order), so request
    keys need not be unique.
    """
    return f"""
req AS ({req_sql}),
w AS (SELECT src, key, prompt, list_distinct(regexp_extract_all(lower(prompt), '[a-z0-9_]+')) AS words
      FROM req),
b AS (SELECT src, key, prompt,
             list_reduce(list_transform({CATALOG_LIST},
                           lambda e: {{'score': len(list_intersect(e.kws, words)), 'fn_name': e.fn_name}}),
                         lambda a, x: CASE WHEN x.score > a.score THEN x ELSE a END) AS best
      FROM w),
sel AS (SELECT src, key, prompt,
               CASE WHEN best.score > 0 THEN best.fn_name ELSE {q(fixed.REFERENCE_CATALOG[0][0])} END AS fn_name,
               CAST(best.score AS INTEGER) AS fn_score
        FROM b)
"""


VALID_MIXED = (f"SELECT src, key, {strip('prompt')} AS prompt FROM ({MIXED_REQUESTS}) "
               f"WHERE prompt IS NOT NULL AND length(prompt) > 0 AND {strip('prompt')} <> ''")


# --- flagship -----------------------------------------------------------------

ORACLE["bind_two_numbers"] = rf"""
WITH r AS (
  SELECT l_orderkey, l_linenumber, {sum_prompt('l_quantity', 'l_linenumber')} AS prompt FROM lineitem),
n AS (SELECT *, regexp_extract_all(prompt, {NUM}) AS nums FROM r),
d AS (SELECT *, {distinct_in_order('nums')} AS dn FROM n)
SELECT l_orderkey, l_linenumber, 'fn_add_numbers' AS fn_name,
       {py_float("coalesce(dn[1], '')")} AS a, {py_float("coalesce(dn[2], '')")} AS b
FROM d
"""

# --- extraction -----------------------------------------------------------------

ORACLE["extract_numbers_requests"] = f"""
WITH r AS (
  SELECT o_orderkey, 'Compare ' || {dec_text('o_totalprice')} || ' with -' || CAST(o_custkey AS VARCHAR)
         || ' and ' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey % 7 AS VARCHAR) AS prompt
  FROM orders),
n AS (SELECT o_orderkey, regexp_extract_all(prompt, {NUM}) AS nums FROM r),
e AS (SELECT o_orderkey, nums, generate_subscripts(nums, 1) AS i FROM n)
SELECT o_orderkey, CAST(i - 1 AS INTEGER) AS pos, nums[i] AS num FROM e
"""

ORACLE["extract_numbers_documents"] = f"""
WITH d AS (SELECT lang, regexp_extract_all(text, {NUM}) AS nums FROM documents)
SELECT lang, count(*) AS n_docs, count(*) FILTER (WHERE len(nums) > 0) AS n_docs_with_numbers,
       CAST(sum(len(nums)) AS BIGINT) AS n_numbers,
       CAST(sum(len(list_filter(nums, lambda x: starts_with(x, '-')))) AS BIGINT) AS n_negative,
       CAST(sum(len(list_filter(nums, lambda x: contains(x, '.')))) AS BIGINT) AS n_decimal,
       CAST(max(len(nums)) AS INTEGER) AS max_per_doc
FROM d GROUP BY lang
"""

ORACLE["substitute_args"] = f"""
WITH r AS (SELECT p_partkey, {substitute_prompt()} AS p FROM part)
SELECT p_partkey, coalesce({sub_source('p')}, '') AS source_string,
       coalesce({sub_regex('p')}, '') AS regex, coalesce({sub_repl('p')}, '') AS replacement
FROM r
"""

ORACLE["quoted_pair"] = f"""
WITH r AS (SELECT p_partkey, {pair_prompt()} AS p FROM part)
SELECT p_partkey, coalesce({pair('p', 1)}, '') AS s1, coalesce({pair('p', 2)}, '') AS s2 FROM r
"""

ORACLE["longest_quoted_pages"] = f"""
WITH r AS (SELECT page_id, {quoted_all('html')} AS qs FROM pages),
l AS (SELECT page_id, qs, {longest('qs')} AS lg FROM r)
SELECT page_id, CAST(len(qs) AS INTEGER) AS n_quoted, nullif(lg, '') AS longest,
       CAST(length(lg) AS INTEGER) AS longest_len
FROM l
"""

ORACLE["name_after_keyword"] = f"""
WITH r AS (
  SELECT 'nation' AS src, CAST(n_nationkey AS BIGINT) AS key, 'Greet ' || n_name AS p FROM nation
  UNION ALL SELECT 'customer', CAST(c_custkey AS BIGINT), 'greet ' || c_name FROM customer
  UNION ALL SELECT 'supplier', CAST(s_suppkey AS BIGINT), 'Please GREET  ' || s_name FROM supplier)
SELECT src, key, coalesce({greet('p')}, '') AS name FROM r
"""

ORACLE["bind_mixed_fold"] = f"""
WITH r AS (
  SELECT p_partkey, 'Repeat ''' || CAST(p_size % 4 AS VARCHAR) || ''' ' || CAST(p_partkey % 4 AS VARCHAR)
         || ' times, then ' || CAST(p_size % 3 AS VARCHAR) || ' more' AS p FROM part),
a AS (SELECT p_partkey, regexp_extract_all(p, {NUM}) AS nums,
             coalesce(regexp_extract_all(p, {ANY_QUOTED}, 1)[1], '') AS s FROM r),
b AS (SELECT *, coalesce(list_filter(nums, lambda x: x <> s)[1], '') AS n FROM a),
c AS (SELECT *, coalesce(list_filter(nums, lambda x: x <> s AND x <> n)[1], '') AS m FROM b)
SELECT p_partkey, s, {py_int('n')} AS n, {py_float('m')} AS m FROM c
"""

ORACLE["bind_closed_form"] = f"""
WITH r AS (SELECT o_orderkey, 'Find the max of ' || CAST(o_custkey % 10 AS VARCHAR) || ' and '
                  || CAST(o_orderkey % 10 AS VARCHAR) AS p FROM orders),
d AS (SELECT o_orderkey, {distinct_in_order('regexp_extract_all(p, ' + NUM + ')')} AS dn FROM r)
SELECT o_orderkey, {py_float("coalesce(dn[1], '')")} AS a, {py_float("coalesce(dn[2], '')")} AS b FROM d
"""

# --- conversion -------------------------------------------------------------------

_RAW_VALUES = ["5.", "-3.9", "abc", "", "yes", "TRUE", "1e3", "007"]

ORACLE["convert_args"] = f"""
WITH v AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 4
      WHEN 0 THEN {dec_text('l_extendedprice')}
      WHEN 1 THEN '-' || {int_text('l_quantity')}
      WHEN 2 THEN ([{', '.join(q(x) for x in _RAW_VALUES)}])[l_orderkey % {len(_RAW_VALUES)} + 1]
      ELSE CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END
    END AS raw,
    (['int', 'float', 'bool', 'str', 'date'])[l_orderkey % 5 + 1] AS arg_type
  FROM lineitem),
c AS (SELECT *, coalesce(raw, '') AS v, TRY_CAST(coalesce(raw, '') AS DOUBLE) AS d FROM v)
SELECT l_orderkey, l_linenumber, arg_type, raw,
  CASE WHEN arg_type = 'int' THEN CASE WHEN v = '' OR d IS NULL THEN 0
                                       ELSE CAST(trunc(d) AS BIGINT) END END AS v_int,
  CASE WHEN arg_type = 'float' THEN CASE WHEN v = '' OR d IS NULL THEN 0.0 ELSE d END END AS v_float,
  CASE WHEN arg_type = 'bool' THEN lower(v) = 'true' END AS v_bool,
  CASE WHEN arg_type = 'str' THEN v WHEN arg_type = 'date' THEN '' END AS v_str,
  CASE WHEN arg_type = 'int' AND v <> '' AND d IS NULL THEN 'bad_int'
       WHEN arg_type = 'float' AND v <> '' AND d IS NULL THEN 'bad_float'
       WHEN arg_type = 'date' THEN 'unknown_type' END AS issue
FROM c
"""

# --- validation ---------------------------------------------------------------------

CONVERSATION_REQUESTS = """
SELECT conv_id, turn,
  CASE (conv_id + turn) % 11
    WHEN 0 THEN '   ' WHEN 1 THEN '' WHEN 2 THEN NULL
    WHEN 3 THEN chr(9) || ' ' || text || ' ' || chr(12288) || chr(10)
    ELSE text END AS prompt
FROM conversations
"""


def request_issue(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN 'missing_prompt' WHEN length({p}) < 1 THEN 'empty_prompt' "
            f"WHEN {strip(p)} = '' THEN 'blank_prompt' END")


ORACLE["validate_requests"] = f"""
WITH r AS ({CONVERSATION_REQUESTS}),
c AS (SELECT conv_id, turn, prompt, {request_issue('prompt')} AS issue FROM r)
SELECT conv_id, turn, issue, CASE WHEN issue IS NULL THEN {strip('prompt')} END AS prompt FROM c
"""

ORACLE["validation_report"] = f"""
WITH r AS ({CONVERSATION_REQUESTS})
SELECT coalesce({request_issue('prompt')}, 'valid') AS outcome, count(*) AS n_rows FROM r GROUP BY 1
"""

ORACLE["validate_catalog"] = """
WITH d AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 9 = 0 THEN p_name WHEN p_partkey % 13 = 0 THEN ''
         ELSE 'fn_' || replace(p_name, ' ', '_') END AS fn_name,
    p_partkey % 7 <> 0 AS has_b,
    CASE WHEN p_partkey % 11 = 0 THEN '' ELSE 'float' END AS return_type
  FROM part)
SELECT p_partkey, fn_name,
  CASE WHEN fn_name IS NULL THEN 'missing_fn_name' WHEN length(fn_name) < 1 THEN 'empty_fn_name'
       WHEN NOT starts_with(fn_name, 'fn_') THEN 'bad_fn_prefix'
       WHEN return_type IS NULL THEN 'missing_return_type'
       WHEN length(return_type) < 1 THEN 'empty_return_type'
       WHEN NOT has_b THEN 'missing_arg_type:b' END AS issue
FROM d
"""

ORACLE["dedupe_catalog"] = """
SELECT min(p_partkey) AS ord, 'fn_' || replace(p_name, ' ', '_') AS fn_name,
       arg_max(p_brand, p_partkey) AS return_type, arg_max(lower(p_type), p_partkey) AS x_type
FROM part GROUP BY p_name
"""

# --- selection and the whole job ---------------------------------------------------

ORACLE["select_function"] = f"""
WITH {selected(MIXED_REQUESTS)}
SELECT src, key, fn_name, fn_score FROM sel
"""
ORACLE["select_function_join"] = ORACLE["select_function"]

NUMERIC_FNS = [n for n, args, _ in fixed.REFERENCE_CATALOG
               if all(t in ("int", "float") for _, t in args)]


def job_args(sel: str) -> str:
    """CTEs ending in ``v``: the raw argument texts of ``sel(src, key, prompt, fn_name)``."""
    return f"""
WITH {sel},
specs(fn_name, arg_ord, arg_name, arg_type) AS ({ARG_SPECS}),
x AS (SELECT sel.*, {distinct_in_order('regexp_extract_all(prompt, ' + NUM + ')')} AS dn FROM sel),
a AS (SELECT x.src, x.key, x.fn_name, x.prompt, x.dn, specs.arg_ord, specs.arg_name, specs.arg_type
      FROM x JOIN specs USING (fn_name)),
v AS (
  SELECT *,
    CASE
      WHEN arg_type IN ('int', 'float') THEN coalesce(dn[arg_ord + 1], '')
      WHEN fn_name = {q(fixed.FN_SUBSTITUTE)} THEN coalesce(CASE arg_name
           WHEN 'source_string' THEN {sub_source('prompt')}
           WHEN 'regex' THEN {sub_regex('prompt')}
           WHEN 'replacement' THEN {sub_repl('prompt')} END, '')
      WHEN fn_name = {q(fixed.FN_CONCATENATE)} THEN coalesce(CASE arg_name
           WHEN 's1' THEN {pair('prompt', 1)} WHEN 's2' THEN {pair('prompt', 2)} END, '')
      WHEN fn_name IN ({', '.join(q(f) for f in fixed.FN_UNARY_STRING)}) THEN {longest(quoted_all('prompt'))}
      WHEN fn_name = {q(fixed.FN_GREET)} THEN coalesce({greet('prompt')}, '')
      ELSE coalesce(regexp_extract_all(prompt, {ANY_QUOTED}, 1)[1], '')
    END AS raw,
    CASE WHEN arg_type IN ('int', 'float') THEN len(dn) > arg_ord ELSE true END AS has_cand
  FROM a)
"""


JOB_ARGS = job_args(f"raw AS ({MIXED_REQUESTS}), {selected(VALID_MIXED)}")

JOB_VALUES = """fn_name, CAST(arg_ord AS INTEGER) AS arg_ord, arg_name, arg_type,
  CASE WHEN arg_type = 'int' THEN CASE WHEN raw = '' THEN 0 ELSE CAST(trunc(CAST(raw AS DOUBLE)) AS BIGINT) END
       END AS v_int,
  CASE WHEN arg_type = 'float' THEN CASE WHEN raw = '' THEN 0.0 ELSE CAST(raw AS DOUBLE) END END AS v_float,
  CASE WHEN arg_type = 'bool' THEN lower(raw) = 'true' END AS v_bool,
  CASE WHEN arg_type NOT IN ('int', 'float', 'bool') THEN raw END AS v_str,
  CAST(NULL AS VARCHAR) AS issue
FROM v
"""

ORACLE["run_job"] = f"{JOB_ARGS} SELECT src, key, {JOB_VALUES}"

ORACLE["run_summary"] = JOB_ARGS + f""",
nac(fn_name, n_numeric) AS ({NUMERIC_ARG_COUNTS}),
allsel AS (SELECT sel.fn_score, nac.n_numeric > len(sel.dn) AS defaulted
           FROM x AS sel JOIN nac USING (fn_name))
SELECT count(*) AS n_calls, CAST(0 AS BIGINT) AS n_fallback,
       count(*) FILTER (WHERE fn_score = 0) AS n_unmatched,
       count(*) FILTER (WHERE defaulted) AS n_defaulted,
       (SELECT count(*) FROM raw WHERE prompt IS NULL OR length(prompt) < 1 OR {strip('prompt')} = '')
         AS n_rejected
FROM allsel
"""

ORACLE["select_candidate"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, {ANY_QUOTED}, 1) AS qs, text FROM documents),
c AS (SELECT doc_id, CASE WHEN len(qs) > 0 THEN qs ELSE regexp_extract_all(text, {NUM}) END AS cands
      FROM d)
SELECT doc_id, CAST(len(cands) AS INTEGER) AS n_cands, coalesce(cands[1], '') AS chosen FROM c
"""

# --- raw calls -------------------------------------------------------------------

EVENT_NAMES = "('fn_click', 'fn_view', 'fn_purchase')"

ORACLE["resolve_calls"] = f"""
SELECT event_id, 'fn_' || event_type AS raw_fn,
       CASE WHEN 'fn_' || event_type IN {EVENT_NAMES} THEN 'fn_' || event_type ELSE 'fn_click' END AS fn_name,
       'fn_' || event_type NOT IN {EVENT_NAMES} AS fn_unknown
FROM events
"""

ORACLE["unknown_calls"] = f"""
SELECT event_id, 'fn_' || event_type AS raw_fn FROM events WHERE 'fn_' || event_type NOT IN {EVENT_NAMES}
"""

ORACLE["decode_calls"] = f"""
WITH e AS (
  SELECT event_id, CASE WHEN 'fn_' || event_type IN {EVENT_NAMES} THEN 'fn_' || event_type
                        ELSE 'fn_click' END AS fn_name,
         json_extract(props, '$.k') AS k FROM events),
specs(fn_name, arg_ord, arg_name, arg_type) AS (VALUES
  ('fn_click', 0, 'k', 'int'), ('fn_click', 1, 'v', 'float'), ('fn_view', 0, 'k', 'str'),
  ('fn_purchase', 0, 'k', 'bool'), ('fn_purchase', 1, 'note', 'str'))
SELECT event_id, fn_name, false AS is_fallback, CAST(arg_ord AS INTEGER) AS arg_ord, arg_name, arg_type,
  CASE WHEN arg_type = 'int' THEN CAST(trunc(CAST(k AS DOUBLE)) AS BIGINT) END AS v_int,
  CASE WHEN arg_type = 'float' THEN CAST(0.0 AS DOUBLE) END AS v_float,
  CASE WHEN arg_type = 'bool' THEN CAST(k AS DOUBLE) <> 0 END AS v_bool,
  CASE WHEN arg_type = 'str' AND arg_name = 'k' THEN CAST(k AS VARCHAR)
       WHEN arg_type = 'str' THEN '' END AS v_str,
  CASE WHEN arg_name IN ('v', 'note') THEN 'missing_arg' END AS issue
FROM e JOIN specs USING (fn_name)
"""

# Arguments by function and payload shape (event_id % 8), as JSON text; NULL: the call falls back.
ORACLE["decode_mixed_calls"] = f"""
WITH e AS (
  SELECT event_id, event_id % 9 = 0 AS blank, event_id % 8 AS shape, json_extract_string(props, '$.k') AS k,
         CASE WHEN 'fn_' || event_type IN {EVENT_NAMES} THEN 'fn_' || event_type ELSE 'fn_click' END AS fn
  FROM events),
a AS (
  SELECT event_id, fn, CASE WHEN blank THEN NULL
    WHEN shape IN (0, 1) THEN NULL
    WHEN fn = 'fn_click' THEN CASE shape
      WHEN 2 THEN '{{"k":' || k || ',"v":' || CASE k WHEN '0' THEN '-5.0' ELSE '-' || k || '5.0' END || '}}'
      WHEN 3 THEN '{{"k":1,"v":0.0}}' WHEN 5 THEN NULL ELSE '{{"k":0,"v":0.0}}' END
    WHEN fn = 'fn_view' THEN '{{"k":"' || CASE shape
      WHEN 2 THEN k || '.5' WHEN 3 THEN 'True' WHEN 4 THEN '[' || k || ']' WHEN 5 THEN 'Infinity'
      WHEN 6 THEN 'yes' ELSE '92233720368547758' || lpad(k, 2, '0') END || '"}}'
    ELSE '{{"k":' || CASE WHEN shape = 5 THEN 'false' ELSE 'true' END || ',"note":"'
         || CASE shape WHEN 6 THEN 'n' || k ELSE '' END || '"}}' END AS args
  FROM e)
SELECT event_id, CASE WHEN args IS NULL THEN 'fn_click' ELSE fn END AS fn_name, args IS NULL AS is_fallback,
       coalesce(args, '{{"k":0,"v":0.0}}') AS args
FROM a
"""

ORACLE["bind_flag"] = """
SELECT c_custkey, 'fn_flag' AS fn_name, '{"id":' || c_custkey || ',"active":true,"again":'
       || CASE WHEN c_nationkey = c_custkey THEN 0 ELSE c_nationkey END || ',"name":"' || c_mktsegment || '"}' AS args
FROM customer
"""

ORACLE["bind_user_rules"] = f"""
WITH r AS (SELECT o_orderkey, 'Ship ' || CAST(o_custkey % 50 AS VARCHAR) || ' of #' || CAST(o_orderkey AS VARCHAR)
                  || ' with code K' || CAST(o_custkey AS VARCHAR) AS p FROM orders),
a AS (SELECT o_orderkey, regexp_extract_all(p, {NUM}) AS nums, regexp_extract(p, '#([0-9]+)', 1) AS order_no,
             regexp_extract(p, 'code ([A-Z][0-9]+)', 1) AS code FROM r),
b AS (SELECT *, coalesce(list_filter(nums, lambda x: x <> order_no AND x <> code)[1], '') AS n FROM a)
SELECT o_orderkey, 'fn_ship' AS fn_name, {py_int('order_no')} AS order_no, code, {py_int('n')} AS n FROM b
"""

# --- prefix index ------------------------------------------------------------------

TOKENS = q(r"[^\t\n\x0b\f\r ]+")

DOC_PREFIX_ROWS = f"""
t AS (SELECT doc_id, regexp_extract_all(text, {TOKENS}) AS toks FROM documents),
e AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, toks[i] AS tok
      FROM (SELECT doc_id, toks, generate_subscripts(toks, 1) AS i FROM t)),
h AS (SELECT *, sum(hash(tok, n)) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS k
      FROM e)
"""

ORACLE["allowed_next_tokens"] = f"""
WITH {DOC_PREFIX_ROWS},
p AS (SELECT doc_id, n, tok, k - hash(tok, n) AS pk FROM h),
edges AS (SELECT n, pk, tok, count(*) AS n_seqs, min(doc_id) AS child_seq FROM p GROUP BY n, pk, tok)
SELECT min(child_seq) OVER (PARTITION BY n, pk) AS node_seq, n AS depth, tok AS next_token,
       n_seqs, child_seq
FROM edges
"""

ORACLE["merge_prefix_index"] = ORACLE["allowed_next_tokens"]

ORACLE["shortest_unique_prefix"] = f"""
WITH {DOC_PREFIX_ROWS},
g AS (SELECT n + 1 AS len, count(*) AS c, min(doc_id) AS doc_id FROM h GROUP BY n, k)
SELECT doc_id AS seq_id, CAST(min(len) AS INTEGER) AS sup_len FROM g WHERE c = 1 GROUP BY doc_id
"""

PERMITTED = """
c AS (SELECT vec_id, embedding, i FROM embeddings, range(0, 72) r(i)
      WHERE i % (label + 2) = vec_id % (label + 2) AND i < len(embedding)),
s AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS score FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, i ASC) AS rn FROM s)
"""

ORACLE["masked_argmax"] = f"""
WITH {PERMITTED}
SELECT e.vec_id, CAST(r.i AS INTEGER) AS token_id, r.score
FROM embeddings e LEFT JOIN r ON e.vec_id = r.vec_id AND r.rn = 1
"""

ORACLE["masked_argmax_long"] = f"""
WITH {PERMITTED}
SELECT vec_id, CAST(i AS INTEGER) AS token_id, score FROM r WHERE rn = 1
"""

# --- token tables -------------------------------------------------------------------


def normalize_sql(x: str) -> str:
    out = x
    for special, repl in fixed.TOKEN_REPLACEMENTS:
        out = f"replace({out}, {q(special)}, {q(repl)})"
    return out


RAW_TOKENS = f"""
t AS (SELECT doc_id, regexp_extract_all(text, {TOKENS}) AS toks FROM documents),
e AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS w
      FROM (SELECT doc_id, toks, generate_subscripts(toks, 1) AS i FROM t)),
rt AS (SELECT CASE pos % 3 WHEN 0 THEN 'Ġ' || w WHEN 1 THEN '▁' || w ELSE w || '</w>' END AS token,
              doc_id * 2147483648 + pos AS o FROM e),
raw AS (SELECT min(o) AS ord, token, min(o) AS token_id FROM rt GROUP BY token),
norm AS (SELECT {normalize_sql('token')} AS token, token_id, ord FROM raw),
vocab AS (SELECT token, arg_max(token_id, ord) AS token_id, count(*) AS n_raw FROM norm GROUP BY token)
"""

ORACLE["normalize_tokens"] = f"""
WITH {RAW_TOKENS}
SELECT token, token_id, n_raw FROM vocab
"""

ORACLE["token_table_report"] = f"""
WITH {RAW_TOKENS}
SELECT (SELECT count(DISTINCT token) FROM raw) AS n_raw_tokens,
       (SELECT count(DISTINCT token) FROM vocab) AS n_tokens
"""

ORACLE["invert_tokens"] = f"""
WITH {RAW_TOKENS},
pairs AS (SELECT CASE WHEN ord % 10 = 0 THEN 'x' || CAST(ord AS VARCHAR)
                      ELSE CAST(ord - CASE WHEN ord % 100 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS key, token AS value, ord FROM raw),
k AS (SELECT TRY_CAST(trim(key) AS BIGINT) AS token_id, value, ord FROM pairs)
SELECT token_id, arg_max(value, ord) AS token FROM k WHERE token_id IS NOT NULL GROUP BY token_id
"""

ORACLE["encode_tokens"] = f"""
WITH {RAW_TOKENS},
bt AS (SELECT item_id, regexp_extract_all(text, {TOKENS}) AS toks FROM benchmark),
be AS (SELECT item_id, i - 1 AS pos, toks[i] AS w
       FROM (SELECT item_id, toks, generate_subscripts(toks, 1) AS i FROM bt)),
lk AS (SELECT be.item_id, be.pos, vocab.token_id, vocab.token
       FROM be LEFT JOIN vocab ON vocab.token = CASE WHEN be.pos > 0 THEN ' ' || be.w ELSE be.w END)
SELECT item_id, count(*) AS n_tokens, count(*) FILTER (WHERE token_id IS NULL) AS n_unknown,
       string_agg(CAST(coalesce(token_id, -1) AS VARCHAR), ' ' ORDER BY pos) AS ids,
       string_agg(coalesce(token, ''), '' ORDER BY pos) AS decoded
FROM lk GROUP BY item_id
"""

ORACLE["encode_longest"] = f"""
WITH RECURSIVE {RAW_TOKENS},
entries AS MATERIALIZED (SELECT token, token_id, length(token) AS size FROM vocab WHERE length(token) > 0),
sizes AS MATERIALIZED (SELECT DISTINCT substr(token, 1, 1) AS c, size FROM entries),
walk AS (
  SELECT item_id, text, 1 AS pos, 0 AS k, CAST(NULL AS BIGINT) AS id FROM benchmark WHERE length(text) > 0
  UNION ALL
  SELECT item_id, any_value(text), pos + coalesce(max(size), 1), any_value(k) + 1,
         coalesce(arg_max(token_id, size), -1 - unicode(substr(any_value(text), pos, 1)))
  FROM (SELECT w.item_id, w.text, w.pos, w.k, e.token_id, e.size
        FROM walk w LEFT JOIN sizes z ON z.c = substr(w.text, w.pos, 1)
        LEFT JOIN entries e ON e.token = substr(w.text, w.pos, z.size)
        WHERE w.pos <= length(w.text)) GROUP BY item_id, pos)
SELECT b.item_id, count(w.id) AS n_tokens, count(*) FILTER (WHERE w.id < 0) AS n_unknown,
       coalesce(string_agg(CAST(w.id AS VARCHAR), ' ' ORDER BY w.k), '') AS ids, any_value(b.text) AS decoded
FROM benchmark b LEFT JOIN walk w ON w.item_id = b.item_id AND w.k > 0 GROUP BY b.item_id
"""

ORACLE["catalog_fingerprints"] = """
SELECT p_partkey AS ord, 'fn_' || replace(p_name, ' ', '_') AS fn_name,
  sha256('{"fn_name":"fn_' || replace(p_name, ' ', '_') || '","args_names":["x","n"],'
         || '"args_types":[{"key":"n","value":"int"},{"key":"x","value":"' || lower(p_type) || '"}],'
         || '"return_type":"' || p_brand || '"}') AS fingerprint
FROM part
"""

ORACLE["stream_calls"] = ORACLE["bind_two_numbers"]

# --- constrained walk: a recursive CTE over the catalogue's token sequences ---------


def _catalog_token_ids() -> list[list[int]]:
    """K9 computed independently: compact JSON of each definition, word tokens,
    ids = ranks of the distinct tokens."""
    import json
    import re
    docs = [json.dumps({"fn_name": n, "args_names": [a for a, _ in args],
                        "args_types": {a: t for a, t in args}, "return_type": r},
                       separators=(",", ":")) for n, args, r in fixed.REFERENCE_CATALOG]
    toks = [re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]", d) for d in docs]
    rank = {t: i for i, t in enumerate(sorted({t for ts in toks for t in ts}))}
    return [[rank[t] for t in ts] for ts in toks]


def _walk_sql(source: str, ids: list[str], permit: str = "{t} < len(s)",
              score: str = "s[{t} + 1]") -> str:
    """Greedy walk for every row of ``source`` (columns ``ids`` and ``s DOUBLE[]``).

    ``permit`` / ``score`` are SQL templates over a token ``{t}``; they may use
    ``k``, the step number, for step-dependent scores.
    """
    seqs = _catalog_token_ids()
    seq_list = "[" + ", ".join("[" + ", ".join(map(str, x)) + "]" for x in seqs) + "]"
    seq_ord = "[" + ", ".join(f"{{'o': {i}, 'ids': [{', '.join(map(str, x))}]}}"
                              for i, x in enumerate(seqs)) + "]"
    names = "[" + ", ".join(q(n) for n, _a, _r in fixed.REFERENCE_CATALOG) + "]"
    max_steps = max(len(x) for x in seqs) + 20
    allowed = (f"list_filter(list_distinct(list_transform(list_filter({seq_list}, "
               f"lambda x: len(x) > len(g) AND x[1:len(g)] = g), lambda x: x[len(g) + 1])), "
               f"lambda t: {permit.format(t='t')})")
    sa, sb = score.format(t="a"), score.format(t="b")
    best = (f"list_reduce({allowed}, lambda a, b: CASE WHEN a < 0 OR {sb} > {sa} "
            f"OR ({sb} = {sa} AND b < a) THEN b ELSE a END, -1)")
    cols = ", ".join(ids)
    return f"""
WITH RECURSIVE walk({cols}, s, g, done, res, steps, k) AS (
  SELECT {cols}, s, CAST([] AS INTEGER[]), false, CAST(-1 AS BIGINT), 0, 0 FROM ({source}) src
  UNION ALL
  SELECT {cols}, s,
         CASE WHEN nxt < 0 THEN g ELSE g2 END,
         nxt < 0 OR len(m) = 1,
         CASE WHEN nxt >= 0 AND len(m) = 1 THEN CAST(m[1].o AS BIGINT) ELSE res END,
         CASE WHEN nxt < 0 THEN steps ELSE steps + 1 END,
         k + 1
  FROM (SELECT *, list_filter({seq_ord}, lambda e: len(e.ids) >= len(g2) AND e.ids[1:len(g2)] = g2) AS m
        FROM (SELECT *, list_append(g, CAST(nxt AS INTEGER)) AS g2
              FROM (SELECT *, {best} AS nxt FROM walk WHERE NOT done AND k < {max_steps}) a) b) c
)
SELECT {cols},
       CASE WHEN res >= 0 THEN ({names})[res + 1] ELSE {q(fixed.REFERENCE_CATALOG[0][0])} END AS fn_name,
       CAST(steps AS INTEGER) AS walk_steps, res >= 0 AS walk_unique
FROM walk WHERE done OR k >= {max_steps}
"""


ORACLE["constrained_walk"] = _walk_sql(
    "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS s FROM embeddings", ["vec_id"])


def _vocab_list() -> str:
    import json
    import re
    docs = [json.dumps({"fn_name": n, "args_names": [a for a, _ in args],
                        "args_types": {a: t for a, t in args}, "return_type": r},
                       separators=(",", ":")) for n, args, r in fixed.REFERENCE_CATALOG]
    vocab = sorted({t for d in docs for t in re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]", d)})
    return "[" + ", ".join(q(v.lower()) for v in vocab) + "]"


# The model double: score of a vocabulary token = its non-overlapping occurrences
# in the lower-cased request (as Python's str.count).
ORACLE["model_walk"] = _walk_sql(f"""
  SELECT src, key, list_transform({_vocab_list()},
           lambda v: CAST((length(lower(prompt)) - length(replace(lower(prompt), v, ''))) // length(v)
                          AS DOUBLE)) AS s
  FROM ({MIXED_REQUESTS}) r""", ["src", "key"])


# Step-dependent scores: token t at step k scores embedding[(t + k) % 64]; token 7 has
# no score (is not permitted) at even steps.
ORACLE["walk_step_scores"] = _walk_sql(
    "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS s FROM embeddings", ["vec_id"],
    permit="NOT ({t} = 7 AND k % 2 = 0)", score="s[(({t} + k) % 64) + 1]")

# Live model double: substring counts minus 0.5 per earlier generation of the token.
ORACLE["model_walk_steps"] = _walk_sql(f"""
  SELECT p_partkey, list_transform({_vocab_list()},
           lambda v: CAST((length(lower(p)) - length(replace(lower(p), v, ''))) // length(v)
                          AS DOUBLE)) AS s
  FROM (SELECT p_partkey, {part_prompt()} AS p FROM part) r""", ["p_partkey"],
    score="(s[{t} + 1] - 0.5 * len(list_filter(g, lambda z: z = {t})))")

# The whole job with a score vector a request (none: nothing is permitted, the first function).
_SCORED = _walk_sql(f"""
  SELECT p_partkey AS key, {strip('prompt')} AS prompt, coalesce(CAST(embedding AS DOUBLE[]), []) AS s
  FROM (SELECT p_partkey, {part_prompt()} AS prompt FROM part) r
  LEFT JOIN embeddings ON vec_id = p_partkey""", ["key", "prompt"])
ORACLE["run_job_scored"] = (job_args(f"sel AS (SELECT 'part' AS src, key, prompt, fn_name FROM ({_SCORED}) w)")
                            + f"SELECT key AS p_partkey, {JOB_VALUES}")

# A catalogue of all of part: prefixes as a table, and the walk joined to it step by step.
ORACLE["walk_part_catalog"] = r"""
WITH RECURSIVE defs AS (
  SELECT min(p_partkey) AS ord, 'fn_' || replace(p_name, ' ', '_') AS fn_name,
         arg_max(lower(p_type), p_partkey) AS x, arg_max(p_brand, p_partkey) AS ret
  FROM part GROUP BY p_name),
seqs AS (SELECT ord, regexp_extract_all('{"fn_name":"' || fn_name || '","args_names":["x","n"],"args_types":{"x":"'
           || x || '","n":"int"},"return_type":"' || ret || '"}', '[A-Za-z0-9]+|[^A-Za-z0-9\s]') AS toks FROM defs),
placed AS (SELECT ord, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM seqs),
voc AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (SELECT DISTINCT token FROM placed)),
ids AS (SELECT ord, list(id ORDER BY pos) AS ids FROM placed JOIN voc USING (token) GROUP BY ord),
pre AS (SELECT ord, ids[1:k] AS g, ids[k + 1] AS t FROM ids, unnest(range(len(ids))) AS r(k)),
edge AS (SELECT g, t, count(*) AS n, min(ord) AS o FROM pre GROUP BY g, t),
node AS (SELECT g AS stem, list({'t': t, 'n': n, 'o': o} ORDER BY t) AS es FROM edge GROUP BY g),
v AS (SELECT vec_id, flatten(list_transform(range(32), lambda i: CAST(embedding AS DOUBLE[]))) AS s FROM embeddings),
walk(vec_id, s, g, res, steps, done) AS (
  SELECT vec_id, s, CAST([] AS BIGINT[]), CAST(-1 AS BIGINT), 0, false FROM v
  UNION ALL
  SELECT vec_id, s, CASE WHEN b IS NULL THEN g ELSE list_append(g, b.t) END,
         CASE WHEN b.n = 1 THEN CAST(b.o AS BIGINT) ELSE -1 END,
         CASE WHEN b IS NULL THEN steps ELSE steps + 1 END, b IS NULL OR b.n = 1
  FROM (SELECT vec_id, s, g, steps, CASE WHEN len(us) > 0 THEN list_reduce(us,
                 lambda a, e: CASE WHEN s[e.t + 1] > s[a.t + 1] THEN e ELSE a END) END AS b
        FROM (SELECT walk.*, list_filter(es, lambda e: e.t < len(s)) AS us
              FROM walk LEFT JOIN node ON stem = g WHERE NOT done) c) d)
SELECT vec_id, fn_name, CAST(steps AS INTEGER) AS walk_steps, res >= 0 AS walk_unique
FROM walk JOIN defs ON ord = CASE WHEN res >= 0 THEN res ELSE (SELECT min(ord) FROM defs) END WHERE done
"""

ORACLE["walk_part_catalog_join"] = ORACLE["walk_part_catalog"]

ORACLE["load_request_array"] = """
SELECT row_number() OVER (ORDER BY o_orderkey) AS req_id,
       'Note, "max" of ' || o_custkey || ' [and], ' || o_orderkey AS prompt FROM orders
"""


def _choice_walk(name: str, source: str) -> str:
    """CTEs: the candidates ``cs`` of each ``k`` of ``source`` walked by character; ``name(k, pick)``."""
    return f"""
{name}_w AS (
  SELECT k, cs, '' AS g, 0 AS n, len(cs) <= 1 AS done FROM {source}
  UNION ALL
  SELECT k, any_value(cs), any_value(g) || arg_max(ch, (coalesce(times, 0), -ascii(ch))), any_value(n) + 1,
         list_contains(any_value(cs), any_value(g) || arg_max(ch, (coalesce(times, 0), -ascii(ch))))
  FROM (SELECT k, cs, g, n, unnest(list_distinct([substr(c, n + 1, 1) for c in cs if starts_with(c, g) and len(c) > n])) AS ch
        FROM {name}_w WHERE NOT done) AS p
  LEFT JOIN bigrams ON pair = (CASE WHEN n = 0 THEN ' ' ELSE right(g, 1) END) || ch GROUP BY k),
{name} AS (SELECT k, CASE WHEN len(cs) <= 1 THEN coalesce(cs[1], '') ELSE g END AS pick FROM {name}_w WHERE done)"""


ORACLE["choose_candidates_model"] = rf"""
WITH RECURSIVE bigrams AS (
  SELECT z[1] || z[2] AS pair, count(*) AS times
  FROM (SELECT unnest(list_zip(c, list_slice(c, 2, len(c)))) AS z FROM (SELECT string_split(text, '') AS c FROM documents))
  WHERE regexp_full_match(z[1] || z[2], '[\x20-\x7E]{{2}}') GROUP BY 1),
req AS (SELECT c_custkey AS k, [CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR),
               CAST(c_custkey AS VARCHAR), CAST(c_custkey % 97 AS VARCHAR)] AS cs FROM customer),
{_choice_walk("a", "req")},
req_b AS (SELECT k, [c for c in cs if c <> pick] AS cs FROM req JOIN a USING (k)),
{_choice_walk("b", "req_b")}
SELECT k AS c_custkey, 'fn_max_of_two' AS fn_name, 'a' AS arg_name, CAST(pick AS DOUBLE) AS v_float FROM a
UNION ALL SELECT k, 'fn_max_of_two', 'b', coalesce(TRY_CAST(pick AS DOUBLE), 0.0) FROM b
"""
