"""Secret scans with corpus-wide ownership frequency.

Every text gives candidate spans: three patterned kinds (assignments, access keys, hex strings), which
are always reported, and `token`: long strings of mixed character classes and high entropy that no
patterned span covers. The candidates' values are hashed and counted over the whole corpus by distinct
repositories and distinct owners. A value that many owners or many repositories hold is a widely copied
example, also if all the repositories are one owner's; one that few of both hold (two owners and three
repositories at most, by default), in however many files, looks like a live credential. `token` spans are
reported only when they are owner-specific; patterned spans carry the same verdict in the counts, and every
reported span carries both numbers.

The scan is one pass over the texts; what is kept is the spans, without text. Frequencies aggregate
(hash, owner, repository) first, so a value in a third of all documents is a handful of rows before it is
counted, and the join back is one that adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import clean_strings, col, fresh, written

#: The kinds in order, and the patterns of the contract.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def entropy(s: str) -> float:
    """Bits per character."""
    return -sum(c / len(s) * math.log2(c / len(s)) for c in map(s.count, set(s)))


def mixed(s: str) -> bool:
    """Looks random: lower, upper and digit characters, and 3.5 bits per character or more."""
    return (any(c.islower() for c in s) and any(c.isupper() for c in s) and any(c.isdigit() for c in s)
            and entropy(s) >= 3.5)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of all candidates, by start, then kind. Ends are exclusive."""
    found = []
    if (":" in text or "=" in text):
        low = text.lower()
        if any(w in low for w in WORDS):
            found += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    taken = sorted((a, b) for a, _, b, _ in found)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for m in TOKEN.finditer(text):
        before = bisect_left(starts, m.end())  # spans that begin before the token's end; do any reach into it?
        if mixed(m.group()) and not (before and reach[before - 1] > m.start()):
            found.append((m.start(), 3, m.end(), m.group()))
    return sorted(found)


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCAN = ("n_assign long, n_access long, n_hex long, base_sha256 string, "
         "found array<struct<start:long,kind:int,end:long,hash:string>>")


def scan_texts(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """Columns ``keep`` as c0.. plus the base counts and digest and the candidates of each text."""
    src = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], col(text_col).alias("t"))
    n = len(keep)
    empty = src.drop("t").limit(0).selectExpr("*", "cast(null as long) as n_assign", "cast(null as long) as n_access",
                                              "cast(null as long) as n_hex", "cast(null as string) as base_sha256",
                                              "cast(null as array<struct<start:long,kind:int,end:long,hash:string>>) as found")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("hash", pa.string())]))

    def run(batches):
        for batch in batches:
            counts, digests, found = [[], [], []], [], []
            for t in clean_strings(batch.column(n)):
                spans = candidates(t.as_py())
                base = [(a, k, b) for a, k, b, _ in spans if k < 3]
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in base))
                digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                found.append([{"start": a, "kind": k, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest()}
                              for a, k, b, v in spans])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(found, kind)],
                names=[*[f"c{i}" for i in range(n)], "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    return src.mapInArrow(run, empty.schema)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) of candidates (hash, owner, repository); null owners and
    repositories count as one."""
    pairs = found.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("hash").agg(F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def scan_secrets(docs: DataFrame, keep: list[str], owner: str = "source", repository: list[str] | None = None,
                 text_col: str = "text", max_owners: int = 2, max_repositories: int = 3) -> DataFrame:
    """Columns ``keep`` plus n_assign, n_access, n_hex, base_sha256, spans, span_owners, span_repositories,
    n_tokens, n_owner_specific and n_copied, one row per document row.

    ``owner`` names the owner column, ``repository`` the columns that name a repository within an owner
    (the owner alone if none). A candidate is owner-specific if at most ``max_owners`` owners and at most
    ``max_repositories`` repositories hold its value; the others are copied. span_owners and
    span_repositories list both numbers for each of the spans, in their order. Null texts count as empty; a null owner is an owner like any other;
    repeated rows each give their row and add no owner; an empty table gives no rows. Kept columns whose
    names clash with the results get a trailing underscore.
    """
    n = len(keep)
    repository = repository or []
    scanned = scan_texts(docs, [*keep, owner, *repository], text_col)
    scanned = written(scanned.withColumn("rid", F.monotonically_increasing_id()), "secrets")
    one = scanned.where(F.size("found") > 0).select(
        "rid", F.col(f"c{n}").cast("string").alias("owner"),
        F.concat_ws("\x1f", *[F.coalesce(F.col(f"c{n + 1 + i}").cast("string"), F.lit("\x00")) for i in range(len(repository))],
                    F.lit("")).alias("repository"), F.inline("found"))
    freq = written(ownership(one.select("hash", "owner", "repository")), "secrets-owners")
    judged = one.select("rid", "start", "kind", "end", "hash").join(freq, "hash").withColumn(
        "own", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))
    # All spans of one text: bounded by the text.
    per_doc = judged.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.when((F.col("kind") < 3) | F.col("own"), F.struct("start", "kind", "end", "n_owners", "n_repositories")))).alias("all"),
        F.sum(((F.col("kind") == 3) & F.col("own")).cast("long")).alias("n_tokens"),
        F.sum(F.col("own").cast("long")).alias("n_owner_specific"), F.sum((~F.col("own")).cast("long")).alias("n_copied"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform("all", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
    held = {f"span_{c}": F.array_join(F.transform("all", lambda s: s[f"n_{c}"].cast("string")), ",") for c in ("owners", "repositories")}
    made = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", *held, "n_tokens", "n_owner_specific", "n_copied"]
    outs = []
    for c in keep:
        outs.append(fresh([*made, *outs], c))
    d = scanned.select("rid", *[F.col(f"c{i}").alias(x) for i, x in enumerate(outs)], *made[:4])
    return (d.join(per_doc.withColumns({"spans": text, **held}), "rid", "left")
            .select(*[col(x) for x in outs], *made[:4], *[F.coalesce(c, F.lit("")).alias(c) for c in made[4:7]],
                    *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in made[7:]]))
