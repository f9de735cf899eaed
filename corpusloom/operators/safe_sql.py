"""SQL expressions that can reject a row, and cannot fail the job.

An expression is rewritten to the forms that give null where one exists, analysed, and walked:
every function in it must be one that never raises, and arguments that could make one raise have
to be literals that do not. Anything else is refused by name before the job starts.
"""

from __future__ import annotations

import re
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions that raise on bad input and have a form that gives null.
TRY_FORMS = (
    "aes_decrypt element_at make_interval make_timestamp parse_json parse_url to_binary to_number"
    " to_timestamp url_decode variant_get"
).split()

# What gives a value or null for any input, without ANSI mode. Operators are named
# as the analyser names them.
NEVER_RAISING = frozenset(
    # Operators and structure.
    "add alias and attributereference between bitwiseand bitwisenot bitwiseor bitwisexor casewhen cast"
    " commonexpressiondef commonexpressionref divide equalnullsafe equalto getarrayitem getarraystructfields"
    " getmapvalue getstructfield greaterthan greaterthanorequal if in inset integraldivide isnan isnotnull"
    " isnull lambdafunction lessthan lessthanorequal literal multiply namedlambdavariable not or outer pmod"
    " remainder subtract unaryminus unarypositive with"
    # Conditions.
    " coalesce greatest ifnull least nullif nullifzero nvl nvl2 zeroifnull"
    # Text.
    " ascii bit_length btrim char char_length character_length chr concat concat_ws contains endswith find_in_set"
    " initcap instr is_valid_utf8 lcase left len length levenshtein locate lower lpad ltrim make_valid_utf8"
    " mask octet_length overlay position replace reverse right rpad rtrim soundex startswith substr substring"
    " substring_index translate trim try_validate_utf8 ucase upper"
    # Digests and codes.
    " base64 bin crc32 hash hex luhn_check md5 sha sha1 sha2 try_aes_decrypt try_to_binary try_url_decode"
    " unhex xxhash64"
    # Numbers.
    " abs cbrt ceil ceiling exp factorial floor isnan ln log log10 log1p log2 pow power round sign signum sqrt"
    " try_add try_divide try_mod try_multiply try_subtract try_to_number width_bucket"
    # Arrays, maps and structs.
    " aggregate all_match any_match array array_compact array_contains array_distinct array_except"
    " array_intersect array_join array_max array_min array_position array_remove array_size array_sort"
    " array_union arrays_overlap cardinality exists filter forall get map map_contains_key map_entries map_keys"
    " map_values named_struct reduce reverse size sort_array struct transform transform_values"
    " try_element_at zip_with"
    # JSON, variants and dates.
    " get_json_object is_variant_null json_array_length json_object_keys schema_of_variant"
    " try_make_interval try_make_timestamp try_parse_json try_parse_url try_to_timestamp try_variant_get"
    " typeof".split()
)

_PATTERNS = {
    "rlike": 1, "regexp": 1, "regexp_like": 1, "regexp_count": 1, "regexp_substr": 1, "regexp_replace": 1,
    "regexp_extract": 1, "regexp_extract_all": 1, "regexp_instr": 1, "split": 1,
}
_GROUPS = {"regexp_extract": 2, "regexp_extract_all": 2, "regexp_instr": 2}

# Text in quotes, quoted names and comments, which hold no calls.
_QUOTED = re.compile(
    r"""\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/""",
    re.DOTALL,
)
_CALL = re.compile(r"\b([A-Za-z_]\w*)(\s*\()")

#: Probes that an expression has to bear; they show literals that no input could mend.
_PROBES = ("", " ", "a", "0", "12.5", "{}", '{"content":"a"}', "é\n日 b")

_ANSI = "spark.sql.ansi.enabled"
_analysing = threading.RLock()


def _outside_quotes(expression: str, change) -> str:
    parts, at = [], 0
    for quoted in _QUOTED.finditer(expression):
        parts += [change(expression[at : quoted.start()]), quoted.group()]
        at = quoted.end()
    return "".join([*parts, change(expression[at:])])


def with_try_forms(expression: str) -> str:
    """The expression with functions that raise replaced by their forms that give null."""

    def renamed(call: re.Match) -> str:
        name = call.group(1).lower()
        return f"try_{name}{call.group(2)}" if name in TRY_FORMS else call.group()

    return _outside_quotes(expression, lambda text: _CALL.sub(renamed, text))


def calls(expression: str) -> set[str]:
    """Names that are called in an expression, outside of quotes and comments."""
    found: set[str] = set()
    _outside_quotes(expression, lambda text: found.update(m[1].lower() for m in _CALL.finditer(text)) or text)
    return found


def _literal(node) -> object:
    """The value of a literal, None for anything else."""
    while node.prettyName() in ("cast", "unaryminus"):
        inner = _literal(node.children().apply(0))
        if node.prettyName() == "unaryminus":
            return -inner if isinstance(inner, int) else None
        return inner
    if node.prettyName() != "literal":
        return None
    value = node.value()
    return value if value is None or isinstance(value, (int, float, bool)) else value.toString()


def _fault(node, jvm) -> str | None:
    """Why a node could raise, or None."""
    name, children = node.prettyName(), node.children()
    argument = lambda at: _literal(children.apply(at)) if at < children.size() else 0
    if name in _PATTERNS:
        pattern = argument(_PATTERNS[name])
        if pattern is None:
            return f"{name} without a literal pattern"
        try:
            groups = jvm.java.util.regex.Pattern.compile(pattern).matcher("").groupCount()
        except Exception:  # noqa: BLE001 - the pattern does not compile
            return f"{name} with the pattern {pattern!r}"
        if name in _GROUPS and children.size() > _GROUPS[name]:
            group = argument(_GROUPS[name])
            if not isinstance(group, int) or not 0 <= group <= groups:
                return f"{name} with a group that its pattern has not"
        if name == "regexp_replace":
            new = argument(2)
            if new is None or not re.fullmatch(r"(?:[^$\\]|\\.|\$\d)*", new, re.DOTALL):
                return "regexp_replace without a plain literal replacement"
            if any(int(g) > groups for g in re.findall(r"(?<!\\)\$(\d)", new)):
                return "regexp_replace with a group that its pattern has not"
            if children.size() > 3 and not (isinstance(argument(3), int) and argument(3) > 0):
                return "regexp_replace without a literal place to start"
        return None
    if name in ("like", "ilike"):
        return None if isinstance(argument(1), str) else f"{name} without a literal pattern"
    if name in ("element_at", "try_element_at") and children.size() > 1:
        if children.apply(0).dataType().typeName() == "map" or argument(1):
            return None
        return "element_at without a literal place other than 0"
    if name == "split_part":
        return None if argument(2) else "split_part without a literal part other than 0"
    if name == "slice":
        length = argument(2)
        return None if argument(1) and isinstance(length, int) and length >= 0 else "slice without fixed bounds"
    if name in ("repeat", "array_repeat"):
        return None if isinstance(argument(1), int) else f"{name} without a literal number"
    return None if name in NEVER_RAISING else name


def _faults(node, jvm) -> set[str]:
    found = {_fault(node, jvm)}
    children = node.children()
    for at in range(children.size()):
        found |= _faults(children.apply(at), jvm)
    return found - {None}


def _probes(spark: SparkSession) -> DataFrame:
    texts = F.array(*[F.lit(text) for text in _PROBES], F.lit(None).cast("string"))
    return spark.range(0, 1, 1, 1).select(F.explode(texts).alias("text"))


def safe_result(
    df: DataFrame, expression: str, constants: dict[str, Column], flags: dict[str, Column]
) -> DataFrame:
    """Add the expression's value as the string column `result`.

    It may use the columns of df, constants, and flags, which are columns of df as well. It is
    analysed without ANSI mode, so that failing casts and divisions give null; the session is
    as before afterwards, and the analysis of other expressions waits meanwhile.
    """
    spark = df.sparkSession
    value = F.expr(with_try_forms(expression)).cast("string")
    names, probes = {**constants, **flags}, None
    with _analysing:
        before = spark.conf.get(_ANSI)
        spark.conf.set(_ANSI, "false")
        try:
            added = df.withColumns(names).withColumn("result", value)
            shown = df.withColumns(names).select(value)
            try:
                always = {name: F.lit(True) for name in flags}
                probes = _probes(spark).withColumns({**constants, **always}).select(value)
            except AnalysisException:
                pass  # it uses columns that only df has
        finally:
            spark.conf.set(_ANSI, before)
    found = shown._jdf.queryExecution().analyzed().expressions()  # noqa: SLF001 - read for names only
    faults: set[str] = set()
    for at in range(found.size()):
        faults |= _faults(found.apply(at), spark._jvm)  # noqa: SLF001
    if faults:
        raise ValueError(f"could fail the job, not the row: {', '.join(sorted(faults))}")
    try:
        if probes is not None:
            probes.collect()
    except Exception as error:
        raise ValueError(f"fails whatever the text: {str(error).splitlines()[0]}") from error
    return added.drop(*names)
