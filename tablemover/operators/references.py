"""Table references of SQL texts as the session's own parser sees them.

The token rule of ``operators.rewrite`` handles texts at corpus scale but cannot know that a name is a table's
alias, that blanks or comments may stand around a dot, or that a back-tick may be doubled inside a name. View
definitions are few -- the driver issues a statement for each -- so they are parsed: the parser's tree says which
names are relations, wherever they stand (sub-queries, common table expressions), and at which characters.
Texts that don't parse fall back to the token rule.

The parser lives in the driver, so it is asked once per *shape*: texts that differ only in names that hold a digit, in
plain literals and in comments parse alike, with their relations at the same tokens. Tasks find the shapes, and carry
what the parser said of one text of a shape over to the others; texts that share no shape are parsed one by one.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pinned
from .rewrite import _mapping_frame, rewrite_references

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library


def _items(seq):
    for k in range(seq.size()):
        yield seq.apply(k)


def _span(node) -> tuple[int, int] | None:
    origin = node.origin()
    a, b = origin.startIndex(), origin.stopIndex()
    return (a.get(), b.get() + 1) if a.isDefined() and b.isDefined() else None


#: One part of a dotted name as the parser writes it: in back-ticks where it needs them.
_PART = re.compile(r"`((?:[^`]|``)*)`|([^.`]+)")


def _parts(name: str) -> tuple[str, ...]:
    return tuple(m.group(1).replace("``", "`") if m.group(1) is not None else m.group(2) for m in _PART.finditer(name))


def parse_references(spark: SparkSession, text: str) -> tuple[list, list, set] | None:
    """(relations, qualified names, aliases) of a query: relations and names of several parts as (parts, start, end) by
    characters, aliases in lower case. None if the text doesn't parse."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception:  # noqa: BLE001 - not a query of this parser's language
        return None
    relations, names, aliases = [], [], set()
    todo, methods = [plan], {}
    while todo:  # every call crosses to the JVM, so leaves are asked no more than they must be
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind in ("UnresolvedRelation", "UnresolvedAttribute"):
            parts = _parts(node.name())
            if len(parts) > 1 and (at := _span(node)):
                (relations if kind == "UnresolvedRelation" else names).append((parts, *at))
            continue
        if kind == "UnresolvedStar":
            if (target := node.target()).isDefined() and (at := _span(node)):
                names.append((tuple(_items(target.get())), *at))
            continue
        if kind == "Literal":
            continue
        if kind == "SubqueryAlias":
            aliases.add(node.alias().lower())
        if kind not in methods:
            methods[kind] = [m for m in ("expressions", "plan") if _has(node, m)]
        todo += _items(node.children())
        if "expressions" in methods[kind]:
            todo += _items(node.expressions())
            if kind == "UnresolvedWith":
                todo += _items(node.innerChildren())
        elif methods[kind]:
            todo.append(node.plan())
    # A common table expression shows up as an alias and as a child: each place once.
    return sorted(set(relations), key=lambda r: r[1]), sorted(set(names), key=lambda r: r[1]), aliases


def parse_all(spark: SparkSession, texts: list) -> list:
    """``parse_references`` of many texts (None of a null one), several at a time: most of it is waiting for the JVM."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(lambda t: None if t is None else parse_references(spark, t), texts))


#: Tokens of a text, as far as shapes need them: literals, comments, quoted names, numbers, words, anything else.
_LEXER = re.compile(r"""'[^']*'|"[^"]*"|`(?:[^`]|``)*`|--[^\r\n]*|/\*(?s:.)*?\*/|\.?[0-9][\w.]*|\w+|\s+|(?s:.)""")
#: What a literal may follow to be a plain value, which the parser doesn't look into.
_BEFORE_VALUE = {"select", "where", "and", "or", "when", "then", "else", "=", "<", ">"}


def lex(text: str) -> tuple[str, list[str], list[str]]:
    """(shape, tokens, names) of a text: the shape is the text with its names that hold a digit (no keyword does)
    numbered, its plain literals and its comments left out; the names are in the order of their numbers. The shape
    is the text itself where in doubt: escapes, variables, hints, nested comments."""
    tokens = _LEXER.findall(text)
    if ("\\" in text or "${" in text or "/*+" in text or not re.match(r"\s*(?i:select|with)\b", text)
            or any(t in ("'", '"', "`") or t.startswith("/*") and "/*" in t[2:] for t in tokens) or "/*" in {a + b for a, b in zip(tokens, tokens[1:])}):
        return text, tokens, []
    quoted = {t[1:-1].replace("``", "`").lower() for t in tokens if t[0] in "`\""}
    shape, names, known, spellings, before = [], [], {}, {}, ""
    for t in tokens:
        if t.startswith(("--", "/*")):
            shape.append(t[:2])
            continue
        if t[0] == "'" and before in _BEFORE_VALUE:
            shape.append("''")
        elif t.isascii() and (t[0].isalpha() or t[0] == "_") and any(c.isdigit() for c in t) and t.lower() not in quoted:
            if t not in spellings:
                # Names that differ by case alone share a number.
                spellings[t] = f"\0{known.setdefault(t.lower(), len(known))}.{len(names)}\0"
                names.append(t)
            shape.append(spellings[t])
        else:
            shape.append(t)
        if not t.isspace():
            before = t.lower()
    return "".join(shape), tokens, names


def _digest(text: str | None) -> str | None:
    return None if text is None else hashlib.md5(lex(text)[0].encode("utf-8", "surrogatepass")).hexdigest()


def carried(text: str, model: str, found: tuple) -> tuple[list, list, set]:
    """What ``parse_references`` finds in ``text``, from what it found in another text of the same shape."""
    if text == model:
        return found
    _, tokens, names = lex(text)
    _, others, old = lex(model)
    rename = dict(zip(old, names))
    low = {a.lower(): b.lower() for a, b in rename.items()}
    # Where the model's tokens begin and end, and where those of the text do.
    at, i, j = {0: 0}, 0, 0
    for a, b in zip(others, tokens):
        i, j = i + len(a), j + len(b)
        at[i] = j
    moved = [[(tuple(rename.get(p, p) for p in parts), at[a], at[b]) for parts, a, b in group] for group in found[:2]]
    return moved[0], moved[1], {low.get(a, a) for a in found[2]}


def _written(found: tuple) -> str:
    return json.dumps([found[0], found[1], sorted(found[2])])


def _read(found: str) -> tuple[list, list, set]:
    relations, names, aliases = json.loads(found)
    return [(tuple(p), a, b) for p, a, b in relations], [(tuple(p), a, b) for p, a, b in names], set(aliases)


def _found_in(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` (one folder's rows) with ``_tm_found``: the references of each text, written as JSON; null if the text is null
    or doesn't parse. The driver sees one text per shape."""
    spark = df.sparkSession
    shaped, _ = pinned(df.withColumn("_tm_shape", F.udf(_digest, "string")(F.col(f"`{text_col}`"))), "shapes")
    models = shaped.where("_tm_shape is not null").groupBy("_tm_shape").agg(F.min(F.col(f"`{text_col}`")).alias("model")).collect()
    parsed = [(r["_tm_shape"], r["model"], _written(f)) for r, f in zip(models, parse_all(spark, [r["model"] for r in models])) if f is not None]
    known = spark.createDataFrame(parsed, "_tm_shape string, _tm_model string, _tm_parsed string")

    def carry(text, model, found):
        return None if found is None else _written(carried(text, model, _read(found)))

    return shaped.join(known, "_tm_shape", "left").withColumn(
        "_tm_found", F.udf(carry, "string")(F.col(f"`{text_col}`"), "_tm_model", "_tm_parsed")).drop("_tm_shape", "_tm_model", "_tm_parsed")


def _has(node, method: str) -> bool:
    """Whether a JVM object has a method without arguments."""
    try:
        node.getClass().getMethod(method, None)
        return True
    except Exception:  # noqa: BLE001
        return False


def _key(parts: tuple, catalog_from: str | None) -> str | None:
    if len(parts) == 3 and catalog_from and parts[0].lower() == catalog_from.lower() or len(parts) == 2:
        return ".".join(parts[-2:]).lower()
    return None


def _quoted(part: str) -> str:
    return part if part.replace("_", "a").isalnum() and part.isascii() and not part[0].isdigit() else "`" + part.replace("`", "``") + "`"


def rewrite_parsed_text(text: str, found: tuple, mapping: dict[str, str], catalog_from: str | None, catalog_to: str | None) -> str:
    """``text`` with its relations mapped (and the catalog swapped), and with them the column names that are qualified
    by a relation's whole name. Names that an alias hides are left alone."""
    relations, names, aliases = found
    swaps, renamed = [], {}
    for parts, a, b in relations:
        key = _key(parts, catalog_from)
        new = mapping.get(key) if key else None
        if key is None or new is None and not (len(parts) == 3 and catalog_to):
            continue
        head = [catalog_to or parts[0]] if len(parts) == 3 else []
        to = ".".join(_quoted(p) for p in head + (new.split(".") if new else list(parts[-2:])))
        swaps.append((a, b, to))
        renamed[tuple(p.lower() for p in parts)] = to
    for parts, a, b in names:
        low = tuple(p.lower() for p in parts)
        for n in (3, 2):
            if low[:n] in renamed and low[0] not in aliases and (len(parts) > n or text[a:b].rstrip().endswith("*")):
                rest = "".join("." + _quoted(p) for p in parts[n:])
                swaps.append((a, b, renamed[low[:n]] + rest + (".*" if text[a:b].rstrip().endswith("*") else "")))
                break
    for a, b, to in sorted(swaps, reverse=True):
        text = text[:a] + to + text[b:]
    return text


def rewrite_parsed(df: DataFrame, text_col: str, mapping: DataFrame | dict, catalog_from: str | None = None,
                   catalog_to: str | None = None, out_col: str = "new_text") -> DataFrame:
    """Add ``out_col``: the references of each text rewritten as the parser finds them, or by the token rule where it
    can't parse. The driver parses one text per shape (see the module's docstring); use ``rewrite_references`` for
    corpora whose texts share no shapes. Null texts stay null; repeated rows each come back."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    text = F.col(f"`{text_col}`")
    mapping = {k.lower(): v for k, v in mapping.items()} if isinstance(mapping, dict) else mapping

    def keys_of(found):
        return [] if found is None else sorted({k for parts, _, _ in _read(found)[0] if (k := _key(parts, catalog_from))})

    def rewrite(text, found, known):
        return None if found is None else rewrite_parsed_text(text, _read(found), known or {}, catalog_from, catalog_to)

    rows, _ = pinned(_found_in(df, text_col).withColumn("_tm_row", F.monotonically_increasing_id())
                     .withColumn("_tm_keys", F.udf(keys_of, "array<string>")("_tm_found")), "parsed")
    known = (rows.select("_tm_row", F.explode("_tm_keys").alias("_tm_key")).join(_mapping_frame(df, mapping), "_tm_key")
             .groupBy("_tm_row").agg(F.map_from_entries(F.collect_list(F.struct("_tm_key", "_tm_value"))).alias("_tm_known")))
    done = rows.where(text.isNull() | F.col("_tm_found").isNotNull()).join(known, "_tm_row", "left")
    out = done.select(*columns, F.udf(rewrite, "string")(text, "_tm_found", "_tm_known").alias(out_col))
    rest = rows.where(text.isNotNull() & F.col("_tm_found").isNull()).select(*columns)
    if not rest.isEmpty():
        out = out.unionByName(rewrite_references(rest, text_col, mapping, catalog_from, catalog_to, out_col=out_col))
    return out


def view_levels(reads: dict[str, set[str]]) -> tuple[dict[str, int], list[list[str]]]:
    """(level of each view, cycles): ``reads`` names the views that each view reads. A view is one level above
    the highest that it reads; views of a cycle, and those above one, come last. Each cycle is its views in
    reading order, beginning with the smallest name."""
    reads = {v: {r for r in rs if r in reads} for v, rs in reads.items()}
    readers: dict[str, list[str]] = {v: [] for v in reads}
    for v, rs in reads.items():
        for r in rs:
            readers[r].append(v)
    level, missing = {}, {v: len(rs) for v, rs in reads.items()}
    todo = sorted(v for v, n in missing.items() if not n)
    while todo:
        following = []
        for v in todo:
            level[v] = max((level[r] + 1 for r in reads[v]), default=0)
            for w in readers[v]:
                missing[w] -= 1
                if not missing[w]:
                    following.append(w)
        todo = following
    left = sorted(v for v in reads if v not in level)
    cycles, grouped, among = [], set(), set(left)
    for v in left:
        if v in grouped:
            continue
        cycle = _cycle_through(v, reads, among)
        if cycle:
            cycles.append(cycle)
            grouped |= set(cycle)
    last = max(level.values(), default=-1) + 1
    return {**level, **{v: last for v in left}}, cycles


def _cycle_through(start: str, reads: dict, among: set) -> list[str] | None:
    """A shortest cycle through ``start``, or None."""
    before = {start: None}
    todo = [start]
    while todo:
        following = []
        for v in todo:
            for r in sorted(reads[v] & among):
                if r == start:
                    path = [v]
                    while before[path[-1]] is not None:
                        path.append(before[path[-1]])
                    path = path[::-1]
                    k = path.index(min(path))
                    return path[k:] + path[:k]
                if r not in before:
                    before[r] = v
                    following.append(r)
        todo = following
    return None


def view_graph(spark: SparkSession, plan: DataFrame, mapping, catalog_from: str | None = None, catalog_to: str | None = None) -> DataFrame:
    """(view, level, cycle): of every target view of a plan, the level on which it can be created, and the cycle that it
    is part of (`a -> b -> a`), if any."""
    rw = rewrite_parsed(plan, "view_text", mapping, catalog_from, catalog_to).where("new_text is not null")
    view = F.lower(F.format_string("%s.%s", F.coalesce("target_schema", F.lit("None")), F.coalesce("target_view", F.lit("None"))))

    def read_by(found):
        return [] if found is None else sorted({".".join(parts[-2:]).lower() for parts, _, _ in _read(found)[0]})

    reads: dict[str, set[str]] = {}
    for r in _found_in(rw.select(view.alias("view"), "new_text"), "new_text").select(
            "view", F.udf(read_by, "array<string>")("_tm_found").alias("reads")).toLocalIterator():
        reads.setdefault(r["view"], set()).update(r["reads"])
    level, cycles = view_levels(reads)
    name = {v: " -> ".join([*c, c[0]]) for c in cycles for v in c}
    return spark.createDataFrame([(v, n, name.get(v)) for v, n in level.items()], "view string, level int, cycle string")


def view_reads(spark: SparkSession, texts: list[tuple[str, str]]) -> dict[str, set[str]]:
    """The views among ``texts`` (name, query) that each of them reads, by lower-cased names."""
    out: dict[str, set[str]] = {v.lower(): set() for v, _ in texts}
    for (v, _), found in zip(texts, parse_all(spark, [t for _, t in texts])):
        for parts, _, _ in (found[0] if found else []):
            out[v.lower()].add(".".join(parts[-2:]).lower())
    return out
