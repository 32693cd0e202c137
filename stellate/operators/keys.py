"""Minimal unique column combinations (K2, business keys of K14), searched level by level.

A combination is a key if no two rows agree on all its columns and none of them holds a NULL; it is minimal if no
part of it is a key. Level k tries combinations of k columns, those of all tables together. What keeps the candidates few:

* a combination with a key inside it is not minimal;
* agree sets: two rows that agree on a set of columns rule out every combination within that set. They come from
  all pairs of a bounded sample and from the duplicates that each level finds. A sample only ever rules out, by two
  rows that really agree; what it leaves is counted on all rows;
* a combination whose columns have fewer possible values together than the table has rows cannot be unique.

What keeps a level small on the network (rows themselves never move, only digests of candidates):

* in a table of more than ``SCREEN_ROWS`` rows each candidate is screened first: of its digests, those in one of
  ``SCREEN`` parts of the digest space are counted. A value that repeats there rules the candidate out. Only what
  the screen leaves, keys and combinations that hardly repeat, goes on;
* the rest is counted on all rows by short digests, ``SPARE`` bits longer than the number of rows needs. Each task sorts
  them and sends their differences, compressed: about three bytes a row and candidate. A row whose short digest is met
  once is unique; the few others are counted again by 64 bits;
* the rows of a few repeated digests are looked up and compared column by column, which gives the agree sets and
  tells true repeats from equal digests of different values. Where the repeats looked up turn out to be the latter,
  the candidate is counted again by 128 bits.

The driver holds column names, candidates, agree sets, a few digests a candidate and the sample (``sample_rows``
digests a table). Short digests met twice are broadcast: at random one row in 2 ** ``SPARE``, and at most ``_SUSPECTS`` a
candidate and group; where there are more and none of those is a true repeat, the candidate is counted by 128 bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import ceil, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.operators.discovery import key_family
from stellate.session import checkpoint_dir

MAX_SIZE = 4
SAMPLE_ROWS = 1000
SCREEN_ROWS = 1 << 20  # larger tables are screened before they are counted
SCREEN = 64  # one part in so many of the digest space
FEW_VALUES = 1 << 16  # columns of about so many values or fewer have them counted, for the bound by their product
WITNESSES = 4  # repeated digests looked up per candidate
SPARE = 14  # bits of a short digest beyond those that number the rows
_COUNTED = 1_000_000  # digests counted in one partition
_PACKED = 1 << 22  # short digests that a task sorts at once, and that one group takes
_SUSPECTS = 4096  # short digests met twice that are looked up, per candidate and group


@dataclass
class _Search:
    """What is known of one table."""

    columns: list[str]
    rows: int = 0
    distinct: dict[int, int] = field(default_factory=dict)  # at most so many values; 0: has NULLs
    agree: list[frozenset] = field(default_factory=list)
    keys: list[tuple[int, ...]] = field(default_factory=list)

    def learn(self, sets) -> None:
        """Add agree sets, keeping those within no other."""
        kept: list[frozenset] = []
        for s in sorted({*self.agree, *sets}, key=len, reverse=True):
            if not any(s <= k for k in kept):
                kept.append(s)
        self.agree = kept

    def candidates(self, size: int) -> list[tuple[int, ...]]:
        free = sorted(i for i, n in self.distinct.items() if n and (i,) not in self.keys)
        out = []
        for c in combinations(free, size):
            s = frozenset(c)
            if any(s.issuperset(k) for k in self.keys) or any(s <= a for a in self.agree) or prod(self.distinct[i] for i in c) < self.rows:
                continue
            out.append(c)
        return out


def agree_sets(rows: np.ndarray) -> set[frozenset]:
    """The sets of columns on which some two of the given rows agree."""
    found: set[bytes] = set()
    for i in range(len(rows) - 1):
        same = np.unique(np.packbits(rows[i + 1:] == rows[i], axis=1), axis=0)
        found.update(r.tobytes() for r in same)
    n = rows.shape[1] if rows.ndim == 2 else 0
    return {frozenset(np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8))[:n]).tolist()) for b in found}


def _col(name: str):
    return F.col(f"`{name}`")


def _signature(columns: list[str]) -> list:
    """One 64-bit digest a column, by which rows are compared."""
    return [F.xxhash64(F.lit(i), _col(c)) for i, c in enumerate(columns)]


def _digests(tables: dict, searches: dict, wanted: list, wide: bool = False) -> DataFrame:
    """(id, h1[, h2]): for every row of a table one digest per candidate in ``wanted``, whose place in the list is the id."""
    parts = []
    for t in dict.fromkeys(t for t, _ in wanted):
        entries = []
        for i, (u, c) in enumerate(wanted):
            if u == t:
                names = [_col(searches[t].columns[j]) for j in c]
                second = [F.xxhash64(F.lit(t), *names).alias("h2")] if wide else []
                entries.append(F.struct(F.lit(i).alias("id"), F.xxhash64(*names).alias("h1"), *second))
        parts.append(tables[t].select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionAll, parts)


def _repeats(digests: DataFrame) -> dict[int, list]:
    """Per candidate with repeated digests up to ``WITNESSES`` of them, each the rarest of its part."""
    keys = digests.columns[1:]
    repeated = digests.groupBy(*digests.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    part = F.shiftrightunsigned("h1", 32).bitwiseAND(WITNESSES - 1).alias("part")
    found: dict[int, list] = {}
    for r in repeated.groupBy("id", part).agg(F.min(F.struct("n", *keys)).alias("rarest")).collect():
        found.setdefault(r["id"], []).append(tuple(r["rarest"][k] for k in keys))
    return found


def _screened(tables: dict, searches: dict, wanted: list) -> dict[int, list]:
    """Repeated digests of the candidates in one of ``SCREEN`` parts of the digest space."""
    return _repeats(_digests(tables, searches, wanted).where(F.pmod("h1", F.lit(SCREEN)) == 0))


def _packed(digests: DataFrame, bits: int, group_bits: int) -> DataFrame:
    """(part, id, packed): the first ``bits`` bits of the digests, sorted within a task, as compressed differences; ``part`` is
    their first ``group_bits`` bits. Of a digest that a task has often, two are sent."""
    most = _PACKED

    def pack(batches):
        codec = pa.Codec("zstd", 1)

        def sent(held):
            ids, h = (np.concatenate(x) for x in zip(*held))
            short = h.view(np.uint64) >> np.uint64(64 - bits)
            rows = []
            for i in np.unique(ids):
                s = np.sort(short[ids == i])
                s = s[np.concatenate([np.ones(min(len(s), 2), bool), s[2:] != s[:-2]])]
                part = (s >> np.uint64(bits - group_bits)).astype(np.int64)
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(starts, [*starts[1:], len(s)]):
                    steps = np.diff(s[a:b], prepend=np.uint64(0))
                    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)  # bytes of equal rank side by side
                    rows.append((int(part[a]), int(i), int(b - a), codec.compress(planes.tobytes(), asbytes=True)))
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k:k + 4096]), kinds)], names=["part", "id", "n", "packed"])

        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= most:
                yield from sent(held)
                held, size = [], 0
        if size:
            yield from sent(held)

    return digests.select("id", "h1").mapInArrow(pack, "part long, id int, n int, packed binary")


def _suspects(digests: DataFrame, bits: int, group_bits: int) -> DataFrame:
    """(id, short, more): the short digests met more than once, at most ``_SUSPECTS`` per candidate and group; ``more``: there
    are others."""
    most = _SUSPECTS

    def twice(table):
        codec = pa.Codec("zstd", 1)
        found = {"id": [], "short": [], "more": []}
        ids, counts, packed = table["id"].to_numpy(), table["n"].to_numpy(), table["packed"]
        for i in np.unique(ids):
            runs = []
            for k in np.flatnonzero(ids == i):
                n = int(counts[k])
                planes = np.frombuffer(codec.decompress(packed[k].as_py(), 8 * n, asbytes=True), np.uint8).reshape(8, n)
                runs.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64))
            s = np.sort(np.concatenate(runs))
            again = np.unique(s[1:][s[1:] == s[:-1]])
            found["id"] += [int(i)] * min(len(again), most)
            found["short"] += again[:most].view(np.int64).tolist()
            found["more"] += [len(again) > most] * min(len(again), most)
        return pa.table(found, schema=pa.schema([("id", pa.int32()), ("short", pa.int64()), ("more", pa.bool_())]))

    return _packed(digests, bits, group_bits).groupBy("part").applyInArrow(twice, "id int, short long, more boolean")


def _counted(tables: dict, searches: dict, wanted: list, wide: bool = False) -> dict[int, list]:
    """Repeated digests of the candidates on all rows. A candidate without a repeat among its looked up short digests, but with
    others not looked up, has an empty list. By 128 bits (``wide``) the digests are moved as they are."""
    digests = _digests(tables, searches, wanted, wide)
    total = sum(searches[t].rows for t, _ in wanted)
    if wide:
        return _repeats(digests.repartition(max(ceil(total / _COUNTED), 1), "h1"))
    bits = min(max(searches[t].rows for t, _ in wanted).bit_length() + SPARE, 64)
    checkpoint_dir(digests.sparkSession)
    suspects = _suspects(digests, bits, min((total // _PACKED).bit_length(), bits)).checkpoint(eager=True)
    crowded = {r["id"]: r["more"] for r in suspects.groupBy("id").agg(F.max("more").alias("more")).collect()}
    if not crowded:
        return {}
    found = _repeats(digests.withColumn("short", F.shiftrightunsigned("h1", 64 - bits)).where(F.col("id").isin(sorted(crowded)))
                     .join(F.broadcast(suspects), ["id", "short"], "left_semi").select("id", "h1"))
    return {i: [] for i, more in crowded.items() if more} | found


def _agreed(tables: dict, searches: dict, wanted: list, repeats: dict) -> dict[int, list[frozenset]]:
    """Per candidate the sets of columns on which all rows of one of its repeated digests agree."""
    parts = []
    for t in dict.fromkeys(t for t, _ in wanted):
        sought = []
        for i, found in repeats.items():
            if wanted[i][0] == t and found:
                digest = F.xxhash64(*[_col(searches[t].columns[j]) for j in wanted[i][1]])
                sought.append(F.when(digest.isin([h[0] for h in found]), F.struct(F.lit(i).alias("id"), digest.alias("h1"))))
        if not sought:
            continue
        signs = [s.alias(f"s{j}") for j, s in enumerate(_signature(searches[t].columns))]
        rows = tables[t].select(F.explode(F.array_compact(F.array(*sought))).alias("of"), *signs).select("of.*", *[f"s{j}" for j in range(len(signs))])
        same = rows.groupBy("id", "h1").agg(*[(F.min(f"s{j}") == F.max(f"s{j}")).alias(f"s{j}") for j in range(len(signs))])
        parts.append(same.select("id", F.array(*[f"s{j}" for j in range(len(signs))]).alias("same")))
    agreed: dict[int, list[frozenset]] = {}
    for r in reduce(DataFrame.unionAll, parts).collect() if parts else []:
        agreed.setdefault(r["id"], []).append(frozenset(j for j, x in enumerate(r["same"]) if x))
    return agreed


def _level(tables: dict, searches: dict, wanted: list, screen_rows: int) -> None:
    """Decide the candidates ``wanted`` (table, columns): learn agree sets of those that repeat, add the others to the keys."""
    def settle(left, repeats):
        """The candidates without repeats, and those whose repeats looked up are different values of equal digests."""
        agreed = _agreed(tables, searches, left, repeats)
        for i, sets in agreed.items():
            searches[left[i][0]].learn(sets)
        ruled_out = {i for i, sets in agreed.items() if any(s.issuperset(left[i][1]) for s in sets)}
        return [x for i, x in enumerate(left) if i not in repeats], [x for i, x in enumerate(left) if i in repeats and i not in ruled_out]

    large = [x for x in wanted if searches[x[0]].rows > screen_rows]
    left = [x for x in wanted if x not in large]
    if large:
        clean, unclear = settle(large, _screened(tables, searches, large))
        left += [x for x in clean + unclear if not any(a.issuperset(x[1]) for a in searches[x[0]].agree)]
    for wide in (False, True):
        if left:
            clean, left = settle(left, _counted(tables, searches, left, wide))
            for t, c in clean:
                searches[t].keys.append(c)


def _values(tables: dict, searches: dict) -> None:
    """Rows of each table, which columns hold NULLs, and at most how many values each has: counted where they are few."""
    stats = [tables[t].select(*[_col(c).alias(f"c{i}") for i, c in enumerate(s.columns)]).agg(
        F.lit(t).alias("t"), F.count(F.lit(1)).alias("rows"), F.array(*[F.count(f"c{i}") for i in range(len(s.columns))]).alias("set"),
        F.array(*[F.approx_count_distinct(f"c{i}") for i in range(len(s.columns))]).alias("about")) for t, s in searches.items()]
    few = []
    for r in reduce(DataFrame.unionAll, stats).collect():
        s = searches[r["t"]]
        s.rows = r["rows"]
        s.distinct = {i: s.rows if n == s.rows else 0 for i, n in enumerate(r["set"])}
        few += [(r["t"], (i,)) for i, n in enumerate(r["about"]) if s.distinct[i] and n <= FEW_VALUES]
    if few:
        for r in _digests(tables, searches, few).distinct().groupBy("id").count().collect():
            t, (i,) = few[r["id"]]
            searches[t].distinct[i] = r["count"]


def unique_combinations(tables: dict, max_size: int = MAX_SIZE, sample_rows: int = SAMPLE_ROWS, columns: dict | None = None,
                        screen_rows: int = SCREEN_ROWS):
    """(keys, scans): per table the minimal unique combinations as tuples of column names, fewest columns first, in column
    order; ``scans`` says how many levels were scanned. ``columns`` limits the columns of a table; by default all that
    can carry a key (numbers but floating ones, texts, dates). Tables of more than ``screen_rows`` rows are screened."""
    searches = {}
    for t in sorted(tables):
        able = [f.name for f in tables[t].schema.fields if key_family(f.dataType)]
        chosen = [c for c in able if columns is None or c in columns.get(t, able)]
        if chosen:
            searches[t] = _Search(chosen)
    if not searches:
        return {}, 0
    samples = reduce(DataFrame.unionAll, [tables[t].limit(sample_rows).select(F.lit(t).alias("t"), F.array(*_signature(s.columns)).alias("s"))
                                          for t, s in searches.items()]).collect()
    for t, s in searches.items():
        rows = np.array([r["s"] for r in samples if r["t"] == t], np.int64)
        if len(rows) > 1:
            s.learn(agree_sets(rows))
    _values(tables, searches)
    scans = 0
    for size in range(1, max_size + 1):
        wanted = [(t, c) for t, s in searches.items() if s.rows for c in s.candidates(size)]
        if wanted:
            scans += 1
            _level(tables, searches, wanted, screen_rows)
    return {t: [tuple(s.columns[i] for i in k) for k in sorted(s.keys, key=lambda k: (len(k), k))] for t, s in searches.items()}, scans


def minimal_keys(tables: dict, max_size: int = MAX_SIZE, **kw) -> DataFrame:
    """(table_name, columns): one row per minimal unique combination."""
    found, _ = unique_combinations(tables, max_size, **kw)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([(t, list(k)) for t, ks in found.items() for k in ks], "table_name string, columns array<string>")


def composite_key(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, columns): of the keys made of several key-like columns (names ending in id, key, num or number), the
    first with the fewest columns; none if there is none."""
    named = [f.name for f in df.schema.fields if f.name.lower().endswith(("id", "key", "num", "number"))]
    found, _ = unique_combinations({table_name: df}, columns={table_name: named})
    several = [k for k in found.get(table_name, []) if len(k) > 1]
    return df.sparkSession.createDataFrame([(table_name, ", ".join(k)) for k in several[:1]], "table_name string, columns string")
