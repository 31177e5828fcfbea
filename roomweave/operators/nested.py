"""Deeply nested records as related flat tables.

A record is parsed in one pass into triples of path, value and ordinals: each leaf path yields a value vector with the
index of its record and its position in every repeated ancestor. Paths are grouped by their innermost repeated ancestor,
and each group is pivoted into one table whose rows carry the record's key and their ordinals. All of this happens on
Arrow vectors inside one scan: nothing is shuffled, and only the columns of the wanted groups are read.

Defined cases: a null or empty array gives no child row; a null entry gives a child row with `present` false; a null
struct gives null leaves; maps are arrays of `key` and `value`; arrays of numbers are values (coordinates), unless
`split_vectors`. Leaves are named by their path below the ancestor with underscores; a name that a record key or an
earlier column has already gets the ancestor's name before it, or a number behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Path = tuple[str, ...]


@dataclass
class Group:
    """The triples of all paths below one repeated ancestor: they share records and ordinals."""

    ancestor: Path
    record: np.ndarray
    ordinals: list[tuple[Path, np.ndarray]]
    present: np.ndarray
    values: dict[Path, pa.Array] = field(default_factory=dict)


def _numeric(kind: pa.DataType) -> bool:
    return pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind)


def _repeated(kind: pa.DataType, split_vectors: bool) -> bool:
    if pa.types.is_map(kind):
        return True
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return split_vectors or not _innermost_numeric(kind)
    return False


def _innermost_numeric(kind: pa.DataType) -> bool:
    while pa.types.is_list(kind) or pa.types.is_large_list(kind):
        kind = kind.value_type
    return _numeric(kind)


def _any_value(a: pa.Array) -> np.ndarray:
    """Where an entry is not null and, if a struct, has at least one field that is not null."""
    valid = pc.is_valid(a).to_numpy(zero_copy_only=False)
    if pa.types.is_struct(a.type):
        inner = np.zeros(len(a), bool)
        for child in a.flatten():
            inner |= _any_value(child)
        return valid & inner
    return valid


def triples(columns: dict[str, pa.Array], split_vectors: bool = False) -> dict[Path, Group]:
    """Path-value-ordinal triples of a batch of records, in groups by repeated ancestor; () holds the records themselves."""
    rows = len(next(iter(columns.values()))) if columns else 0
    groups = {(): Group((), np.arange(rows), [], np.ones(rows, bool))}

    def parse(a: pa.Array, path: Path, group: Group) -> None:
        kind = a.type
        if pa.types.is_struct(kind):
            for name, child in zip((f.name for f in kind), a.flatten(), strict=True):
                parse(child, (*path, name), group)
        elif _repeated(kind, split_vectors):
            if pa.types.is_map(kind):
                a = a.cast(pa.list_(pa.struct([("key", kind.key_type), ("value", kind.item_type)])))
            parent = pc.list_parent_indices(a).to_numpy(zero_copy_only=False).astype(np.int64)
            entries = pc.list_flatten(a)
            first = np.searchsorted(parent, parent, side="left")
            at = np.arange(len(parent)) - first
            below = Group(path, group.record[parent], [*((p, o[parent]) for p, o in group.ordinals), (path, at.astype(np.int32))], _any_value(entries))
            groups[path] = below
            if pa.types.is_struct(entries.type):
                parse(entries, path, below)
            else:
                parse(entries, (*path, "value"), below)
        else:
            group.values[path] = a

    for name, a in columns.items():
        parse(a, (name,), groups[()])
    return groups


def unclashed(names: list[str], taken: list[str], ancestor: Path) -> list[str]:
    """The names, changed where they are taken already."""
    used, out = set(taken), []
    for name in names:
        new = name if name not in used else "_".join([*ancestor, name])
        n = 2
        while new in used:
            new, n = f"{name}_{n}", n + 1
        used.add(new)
        out.append(new)
    return out


def pivot(group: Group, keys: dict[str, pa.Array]) -> pa.Table:
    """One table of a group: record keys, a position for each repeated ancestor, `present`, then a column a path."""
    at = pa.array(group.record)
    columns = [("_".join(path) + "_pos", pa.array(ordinal, pa.int32())) for path, ordinal in group.ordinals]
    if group.ancestor:
        columns.append(("present", pa.array(group.present)))
    columns += [("_".join(path[len(group.ancestor):]), a) for path, a in group.values.items()]
    names = unclashed([n for n, _ in columns], list(keys), group.ancestor)
    return pa.Table.from_arrays([*(a.take(at) for a in keys.values()), *(a for _, a in columns)], names=[*keys, *names])


def path_groups(schema: T.StructType, columns: list[str], split_vectors: bool = False) -> dict[Path, T.StructType]:
    """The tables that the records' schema gives: ancestor path to the table's schema without record keys."""
    out: dict[Path, list[T.StructField]] = {(): []}

    def numeric(kind: T.DataType) -> bool:
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        return isinstance(kind, T.NumericType | T.BooleanType) and not isinstance(kind, T.DecimalType)

    def walk(kind: T.DataType, path: Path, ancestor: Path, positions: list[Path]) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, (*path, f.name), ancestor, positions)
        elif isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and (split_vectors or not numeric(kind)):
            above = [*positions, path]
            out[path] = [T.StructField("_".join(p) + "_pos", T.IntegerType()) for p in above] + [T.StructField("present", T.BooleanType())]
            if isinstance(kind, T.MapType):
                kind = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
            else:
                kind = kind.elementType
            walk(kind, path if isinstance(kind, T.StructType) else (*path, "value"), path, above)
        else:
            out[ancestor].append(T.StructField("_".join(path[len(ancestor):]), kind))

    for name in columns:
        walk(schema[name].dataType, (name,), (), [])
    return {path: T.StructType(fields) for path, fields in out.items()}


def _combined(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return dict(zip(batch.schema.names, batch.columns, strict=True))


def flat_table(records: DataFrame, keys: list[str], columns: list[str], ancestor: str = "", split_vectors: bool = False) -> DataFrame:
    """The flat table of one repeated ancestor (dotted path; "" for the records themselves).

    Child rows lead back to their record by `keys` and to each ancestor entry by its `_pos`.
    """
    path = tuple(ancestor.split(".")) if ancestor else ()
    groups = path_groups(records.schema, columns, split_vectors)
    if path not in groups:
        raise ValueError(f"no repeated ancestor {ancestor!r}; there are {sorted('.'.join(p) for p in groups)}")
    fields = groups[path].fields
    names = [*keys, *unclashed([f.name for f in fields], keys, path)]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, [*(records.schema[k] for k in keys), *fields], strict=True)])
    wanted = [c for c in columns if not path or c == path[0]]

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _combined(batch)
            parsed = triples({f"{c}": own[c] for c in wanted}, split_vectors)
            made = pivot(parsed[path], {k: own[k] for k in keys})
            yield from made.select(names).to_batches()

    return records.select(*dict.fromkeys([*keys, *wanted])).mapInArrow(shred, schema)


@dataclass(frozen=True)
class Link:
    """How rows of a child table name an entry of a table of the same record.

    `child` and `to` are repeated ancestors, `on` and `to_on` leaf columns of their tables; `fold` ignores case. With
    `own` a row whose name is null leads to itself. `blank` says whether blank names are kept as rows.
    """

    kind: str
    child: str
    on: str
    to: str
    to_on: str
    fold: bool = False
    own: bool = False
    blank: bool = True


def _name(a: pa.Array, fold: bool) -> pa.Array:
    a = pc.utf8_trim_whitespace(a.cast(pa.string()))
    return pc.utf8_lower(a) if fold else a


def _codes(arrays: list[pa.Array]) -> list[np.ndarray]:
    """Integer codes that are equal over all arrays where the texts are; -1 for null."""
    coded = pa.chunked_array(arrays).combine_chunks()
    coded = coded.dictionary_encode() if not isinstance(coded, pa.ChunkedArray) else pa.concat_arrays(arrays).dictionary_encode()
    codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(codes, np.cumsum([len(a) for a in arrays])[:-1])


def child_links(records: DataFrame, key: str, columns: list[str], links: list[Link]) -> DataFrame:
    """(key, child_kind, child_pos, link_pos): one row a child with content, led to the lowest entry that it names, or -1."""
    schema = T.StructType([records.schema[key], T.StructField("child_kind", T.StringType()), T.StructField("child_pos", T.IntegerType()), T.StructField("link_pos", T.IntegerType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _combined(batch)
            parsed = triples({c: own[c] for c in columns})
            tables = {p: pivot(g, {"_record": pa.array(np.arange(batch.num_rows))}) for p, g in parsed.items()}
            for link in links:
                child, to = (tuple(x.split(".")) for x in (link.child, link.to))
                yield from _led(link, tables[child], tables[to], child, to, own[key], schema)

    return records.select(key, *columns).mapInArrow(emit, schema)


def _led(link: Link, rows: pa.Table, there: pa.Table, child: Path, to: Path, keys: pa.Array, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    column: Callable[[pa.Table, str], pa.Array] = lambda t, n: pa.concat_arrays(t.column(n).chunks) if t.column(n).num_chunks else pa.array([], t.schema.field(n).type)
    name, names = _name(column(rows, link.on), link.fold), _name(column(there, link.to_on), link.fold)
    a, b = _codes([name, names])
    span = int(max(a.max(initial=-1), b.max(initial=-1))) + 2
    record, records = (column(t, "_record").to_numpy().astype(np.int64) for t in (rows, there))
    at, ats = column(rows, "_".join(child) + "_pos").to_numpy(), column(there, "_".join(to) + "_pos").to_numpy()
    named = b >= 0
    spots, first = np.unique((records * span + b)[named], return_index=True)  # entries come in order of position
    lowest = ats[named][first]
    mine = record * span + a
    where = np.searchsorted(spots, mine)
    hit = (where < len(spots)) & (a >= 0)
    hit[hit] = spots[where[hit]] == mine[hit]
    led = np.full(len(a), -1, np.int32)
    led[hit] = lowest[where[hit]]
    if link.own:
        led[a < 0] = at[a < 0]
    keep = column(rows, "present").to_numpy(zero_copy_only=False).astype(bool)
    if not link.blank:
        keep &= (a >= 0) & (pc.fill_null(pc.utf8_length(name), 0).to_numpy(zero_copy_only=False) > 0)
    take = np.flatnonzero(keep)
    out = pa.table({
        schema.names[0]: keys.take(pa.array(record[take])),
        "child_kind": pa.array([link.kind]).take(pa.array(np.zeros(len(take), np.int64))),
        "child_pos": pa.array(at[take], pa.int32()),
        "link_pos": pa.array(led[take], pa.int32()),
    })
    yield from out.to_batches()
