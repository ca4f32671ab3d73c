"""YAML manifests read as events, not as Python maps: nothing is dropped on the way.

A YAML loader builds a map per document, so of two equal keys the last one wins, at any level, without a word.
Here the node tree is walked instead: both entries come back, each with its file, document and line, and every
repeated key is a problem row. A file may hold several documents (``---``); all of them count. Files are
parsed side by side. A task never holds a file: its lines go to a temporary file, which is read as a stream of events,
once to see how far it can be read, and once for its entries, of which one at a time is a tree.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library

#: ``entry`` rows have ``fields``; ``problem`` rows have a ``problem`` and no fields.
SCHEMA = ("file string, document int, line int, entry string, fields map<string,string>, problem string, detail string")
_ARROW = pa.schema([("file", pa.string()), ("document", pa.int32()), ("line", pa.int32()), ("entry", pa.string()),
                    ("fields", pa.map_(pa.string(), pa.string())), ("problem", pa.string()), ("detail", pa.string())])

_NULL, _MERGE = "tag:yaml.org,2002:null", "tag:yaml.org,2002:merge"


def _pairs(node, where: str, problems: list) -> list[tuple]:
    """(key, value node, line) of a mapping in their order, with merged (``<<``) defaults that no key of its own
    replaces. A key that comes twice is a problem, and both pairs stay."""
    import yaml

    own, merged, seen = [], [], {}
    for k, v in node.value:
        line = k.start_mark.line + 1
        if k.tag == _MERGE:
            for base in (v.value if isinstance(v, yaml.SequenceNode) else [v]):
                if isinstance(base, yaml.MappingNode):
                    merged += [p for p in _pairs(base, where, []) if p[0] not in {m[0] for m in merged}]
            continue
        key = k.value if isinstance(k, yaml.ScalarNode) else yaml.serialize(k).strip()
        if key in seen:
            problems.append((line, key, "DUPLICATE_YAML_KEY", f"{where}{key} is also at line {seen[key]}"))
        seen.setdefault(key, line)
        own.append((key, v, line))
    return own + [p for p in merged if p[0] not in seen]


def _text(node) -> str | None:
    import yaml

    if isinstance(node, yaml.ScalarNode):
        return None if node.tag == _NULL else node.value
    return yaml.serialize(node).strip()


def _loader():
    """Events by libyaml where it is there, trees by PyYAML's composer."""
    import yaml

    class Loader(*((yaml.cyaml.CParser,) if yaml.__with_libyaml__ else (yaml.reader.Reader, yaml.scanner.Scanner, yaml.parser.Parser)),
                 yaml.composer.Composer, yaml.resolver.Resolver):
        def __init__(self, stream):
            if yaml.__with_libyaml__:
                yaml.cyaml.CParser.__init__(self, stream)
            else:
                yaml.reader.Reader.__init__(self, stream)
                yaml.scanner.Scanner.__init__(self)
                yaml.parser.Parser.__init__(self)
            yaml.composer.Composer.__init__(self)
            yaml.resolver.Resolver.__init__(self)

        def node(self):
            return yaml.composer.Composer.compose_node(self, None, None)

    return Loader


def _readable(path: str) -> tuple[int, Exception | None]:
    """How many documents of the file can be read, and what is wrong with the next."""
    import yaml

    documents, anchors = 0, set()
    try:
        with open(path, "rb") as f:
            loader = _loader()(f)
            while loader.check_event():
                event = loader.get_event()
                if isinstance(event, yaml.DocumentEndEvent):
                    documents, anchors = documents + 1, set()
                elif isinstance(event, yaml.AliasEvent) and event.anchor not in anchors:
                    raise yaml.composer.ComposerError(None, None, f"found undefined alias {event.anchor!r}", event.start_mark)
                elif getattr(event, "anchor", None) is not None:
                    anchors.add(event.anchor)
    except yaml.YAMLError as e:
        return documents, e
    return documents, None


def _walk(loader, where: str, problems: list, node=None) -> Iterator[tuple]:
    """``_pairs`` of the mapping that comes next in the stream (or of ``node``), as (key, node or None, line): None stands for
    a mapping without an anchor, which is still in the stream and must be walked before the next pair is asked for."""
    import yaml

    if node is not None:
        yield from _pairs(node, where, problems)
        return
    loader.get_event()
    merged, seen = [], {}
    while not loader.check_event(yaml.MappingEndEvent):
        k = loader.node()
        line = k.start_mark.line + 1
        if k.tag == _MERGE:
            v = loader.node()
            for base in (v.value if isinstance(v, yaml.SequenceNode) else [v]):
                if isinstance(base, yaml.MappingNode):
                    merged += [p for p in _pairs(base, where, []) if p[0] not in {m[0] for m in merged}]
            continue
        key = k.value if isinstance(k, yaml.ScalarNode) else yaml.serialize(k).strip()
        if key in seen:
            problems.append((line, key, "DUPLICATE_YAML_KEY", f"{where}{key} is also at line {seen[key]}"))
        seen.setdefault(key, line)
        yield key, None if _open_mapping(loader) else loader.node(), line
    loader.get_event()
    yield from (p for p in merged if p[0] not in seen)


def _open_mapping(loader) -> bool:
    import yaml

    return loader.check_event(yaml.MappingStartEvent) and loader.peek_event().anchor is None


def _is_mapping(node) -> bool:
    import yaml

    return node is None or isinstance(node, yaml.MappingNode)


def parse(path: str, root: str, leaf: str) -> Iterator[tuple]:
    """(document, line, entry, fields, problem, detail) of one file."""
    import yaml

    documents, wrong = _readable(path)
    sections = 0
    with open(path, "rb") as f:
        loader = _loader()(f)
        if documents:
            loader.get_event()  # the stream's start
        for number in range(documents):
            problems: list = []
            loader.get_event()
            top = None if _open_mapping(loader) else loader.node()
            if _is_mapping(top):
                for key, part, line in _walk(loader, "", problems, top):
                    if key != root or not _is_mapping(part):
                        if part is None:
                            loader.node()
                        continue
                    for name, section, at in _walk(loader, f"{root}.", problems, part):
                        if name != leaf:
                            if section is None:
                                loader.node()
                            continue
                        sections += 1
                        if not _is_mapping(section):
                            if _text(section) is not None:
                                problems.append((at, None, "NOT_A_MAPPING", f"{root}.{leaf} has no entries"))
                            continue
                        for entry, body, start in _walk(loader, f"{root}.{leaf}.", problems, section):
                            body = loader.node() if body is None else body
                            if isinstance(body, yaml.MappingNode):
                                fields = _pairs(body, f"{root}.{leaf}.{entry}.", problems)
                                yield number, start, entry, {k: _text(v) for k, v, _ in fields}, None, None
                            else:
                                problems.append((start, entry, "NOT_A_MAPPING", f"{root}.{leaf}.{entry} has no fields"))
            loader.get_event()
            loader.anchors = {}
            for line, key, problem, detail in problems:
                yield number, line, key, None, problem, detail
    if wrong is not None:
        mark = getattr(wrong, "problem_mark", None) or getattr(wrong, "context_mark", None)
        yield documents, mark.line + 1 if mark else None, None, None, "YAML_ERROR", " ".join(str(wrong).replace(path, "<unicode string>").split())
    if not sections:
        yield max(documents - (wrong is None), 0), None, None, None, "NO_SECTION", f"no {root}.{leaf} in the file"


def read_entries(spark: SparkSession, path: str, root: str, leaf: str) -> DataFrame:
    """Every entry and every problem of the YAML files at ``path``.

    Problems: ``DUPLICATE_YAML_KEY`` (a key that stands twice in one mapping: a section, an entry or a field;
    of a field that stands twice the last value is taken), ``NOT_A_MAPPING`` (an entry without fields),
    ``YAML_ERROR`` (the rest of the file can't be read, its document included), ``NO_SECTION`` (the file has no such entries at
    all). Values keep the text they have in the file; null values are null. A file is read by one task.
    """
    def entries(file, path):
        for r in parse(path, root, leaf):
            yield (file, *r)

    def files(batches):
        """(file, path of a temporary copy) of each file, whose lines come one after the other."""
        at, out, size, total = None, None, 0, 0
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "file.yaml")
            for b in batches:
                for file, line, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    if file != at:
                        if out:
                            out.close()
                            yield at, path
                        at, out, size, total = file, open(path, "wb"), 0, length
                    text = (line or "").encode()
                    size += len(text) + 1
                    out.write(text if size > total else text + b"\n")  # the last line may have no end
            if out:
                out.close()
                yield at, path

    def batch(rows):
        cells = list(zip(*rows)) or [()] * len(_ARROW)
        return pa.RecordBatch.from_arrays(
            [pa.array([list(v.items()) if isinstance(v, dict) else v for v in c], f.type) for c, f in zip(cells, _ARROW)], schema=_ARROW)

    def run(batches):
        rows = []
        for file, path in files(batches):
            for r in entries(file, path):
                rows.append(r)
                if len(rows) == 5000:
                    yield batch(rows)
                    rows = []
        yield batch(rows)

    meta = {"file": "file_path", "length": "file_size", "block": "file_block_start"}
    lines = spark.read.text(path, lineSep="\n").select(
        "value", *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()], F.monotonically_increasing_id().alias("place"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(n, "file").sortWithinPartitions("file", "block", "place").select("file", "value", "length").mapInArrow(run, SCHEMA)
