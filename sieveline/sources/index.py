"""A document index as catalog tables that two views publish.

``<database>.<scope>_<type>_active`` and ``..._backup`` are views, each over one table. A change
joins the table that a view publishes with the batch, writes the result as a new table and replaces
the view. No table is ever written twice: a write that stops before its view is replaced has changed
nothing, and frames taken earlier go on reading what they read, until :meth:`~DocumentIndex.expire`
drops the tables that no view publishes.

A change scans and writes the copy once, without shuffling it where the batch is small; so changes
should come in batches. One writer at a time: logs, concurrent writers and changes at the cost of
their own size are what table formats bring, which take the same frames (``sources.mutations``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import Analysis
from ..operators.matching import suggest
from ..plans.search import SearchRequest, SearchResult, empty_result, search
from ..schema import KEY, FieldError, FieldSpec, specs_of, to_schema
from ..sizing import BROADCAST_LIMIT_BYTES, broadcast_if_small, measured_bytes, staged
from .documents import (
    PRESENT,
    SEQ,
    assemble,
    check_types,
    collect_specs,
    infer_fields,
    key_spec,
    read_documents,
)
from .mutations import evolve, latest, merge_update, mutation_report, remove, upsert

ACTIVE, BACKUP = "active", "backup"
# Order of the documents within a batch; property of a view that names its table.
ORDER, TABLE = "__order", "sieveline.table"


class DocumentIndex:
    """Index of one document type in a database of the catalog.

    The database says where the tables lie (``CREATE DATABASE ... LOCATION ...``). ``scope`` and
    ``doc_type`` become parts of names: letters, digits and underscores only.
    """

    def __init__(
        self, spark: SparkSession, database: str, scope: str, doc_type: str, analysis: Analysis = Analysis()
    ):
        self.spark = spark
        self.database = database
        self.name = f"{scope}_{doc_type}".lower()
        self.analysis = analysis

    # -- reading -------------------------------------------------------------

    def view(self, use_backup: bool = False) -> str:
        """Name of the view that publishes a copy."""
        return f"{self.database}.{self.name}_{BACKUP if use_backup else ACTIVE}"

    def _stored(self, use_backup: bool) -> DataFrame | None:
        """Rows of a copy with the ``__seq`` that the view does not show."""
        view = self.view(use_backup)
        if not self.spark.catalog.tableExists(view):
            return None
        properties = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
        return self.spark.table(f"{self.database}.{properties[TABLE]}")

    def table(self, use_backup: bool = False) -> DataFrame | None:
        """Documents of the active (or backup) copy; ``None`` if there is none."""
        view = self.view(use_backup)
        return self.spark.table(view) if self.spark.catalog.tableExists(view) else None

    def get(self, ids: Sequence[str]) -> DataFrame | None:
        """Documents with these ids; row groups whose Bloom filters hold none of them are not read."""
        table = self.table()
        return None if table is None else table.filter(F.col(KEY).isin(list(ids)))

    def search(self, request: SearchRequest) -> SearchResult:
        table = self.table(request.use_backup)
        return empty_result(self.spark) if table is None else search(table, request, self.analysis)

    def suggest(self, query: str, fields: Sequence[str], size: int = 5) -> DataFrame:
        table = self.table()
        if table is None:
            return self.spark.createDataFrame([], "text string")
        return suggest(table, query, fields, size)

    # -- writing -------------------------------------------------------------

    def index(self, documents: DataFrame, continued: bool = False) -> DataFrame:
        """Insert or replace documents (long form); new fields widen the schema.

        With ``continued``, a document whose id and ``seq`` are those of the stored one is more of
        the same document and merged into it: a batch that comes twice changes nothing.
        """
        return self._write(documents, False, "continue" if continued else "upsert")

    def index_partial(self, documents: DataFrame) -> DataFrame:
        """Overwrite only the supplied fields; a field the schema lacks raises."""
        return self._write(documents, False, "merge")

    def index_with_backup(self, documents: DataFrame) -> DataFrame:
        """Add to the backup copy while readers stay on the active one."""
        return self._write(documents, True, "upsert")

    def rebuild(self, documents: DataFrame) -> DataFrame:
        """Fill a new backup copy with these documents only, whatever the backup held."""
        return self._write(documents, True, "upsert", fresh=True)

    def create(self, sample: DataFrame) -> None:
        """Make an empty backup copy with the schema of sample documents (long form)."""
        if self.table(use_backup=True) is None:
            specs = collect_specs(infer_fields(read_documents(sample)))
            self._publish(True, self._store(self._empty([key_spec(), *specs])))

    def remove(self, keys: DataFrame) -> DataFrame:
        """Delete the documents whose ``__id`` is given."""
        stored = self._stored(False)
        if stored is None:
            raise FieldError(f"index {self.name!r} does not exist")
        keys = staged(keys.select(F.col(KEY).cast("string")).distinct(), f"{self.name}-keys")
        limit = _limit(keys)
        self._publish(False, self._store(remove(stored, keys, limit=limit)))
        return mutation_report(stored, keys, "remove", limit=limit)

    def swap(self) -> None:
        """Exchange what the two views publish, one after the other; nothing happens without a backup.

        An index that has no active copy yet keeps an empty one as its backup.
        """
        active, backup = self._stored(False), self._stored(True)
        if backup is None:
            return
        fresh = self._table_of(True)
        old = self._store(self._empty(specs_of(self.table(True).schema))) if active is None else self._table_of(False)
        self._publish(False, fresh)
        self._publish(True, old)

    def forget_backup(self) -> None:
        """Drop the view of the backup copy."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.view(True)}")

    def expire(self) -> list[str]:
        """Drop the tables of this index that no view publishes; frames that still read them fail."""
        published = {self._table_of(b) for b in (False, True) if self.table(b) is not None}
        names = [r.tableName for r in self.spark.sql(f"SHOW TABLES IN {self.database}").collect()]
        own = re.compile(rf"{self.name}_v_[0-9a-f]{{32}}")
        dropped = sorted(n for n in names if own.fullmatch(n) and n not in published)
        for name in dropped:
            self.spark.sql(f"DROP TABLE {self.database}.{name}")
        return dropped

    def _table_of(self, use_backup: bool) -> str:
        row = self.spark.sql(f"SHOW TBLPROPERTIES {self.view(use_backup)} ('{TABLE}')").first()
        return row.value

    def _empty(self, specs: Sequence[FieldSpec]) -> DataFrame:
        return self.spark.createDataFrame([], to_schema(specs)).withColumn(SEQ, F.lit(None).cast("long"))

    def _store(self, rows: DataFrame) -> str:
        """Write a new table of this index; its name."""
        name = f"{self.name}_v_{uuid.uuid4().hex}"
        writer = rows.write.option(f"parquet.bloom.filter.enabled#{KEY}", "true")
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").saveAsTable(f"{self.database}.{name}")
        return name

    def _publish(self, use_backup: bool, name: str) -> None:
        """Let the view of a copy show this table."""
        table = f"{self.database}.{name}"
        columns = ", ".join(f"`{c.replace('`', '``')}`" for c in self.spark.table(table).columns if c != SEQ)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view(use_backup)} TBLPROPERTIES ('{TABLE}'='{name}') AS SELECT {columns} FROM {table}"
        )

    def _write(self, documents: DataFrame, use_backup: bool, kind: str, fresh: bool = False) -> DataFrame:
        long = read_documents(documents).filter(F.col("name") != KEY)
        stored = None if fresh else self._stored(use_backup)
        known = [] if stored is None else [s for s in specs_of(stored.drop(SEQ).schema) if not s.is_key]
        specs = collect_specs(infer_fields(long, known), known)
        if kind == "merge" and len(specs) > len(known):
            raise FieldError(f"partial update with unknown fields {[s.name for s in specs[len(known):]]}")
        check_types(long, specs, "raise")
        fields = [key_spec(), *specs]
        # A copy of ``seq`` orders the batch; ``seq`` itself is stored.
        batch = assemble(long, specs, present=PRESENT).withColumn(ORDER, F.col(SEQ))
        if kind != "merge":
            named = [s.name for s in fields]
            batch = latest(batch, KEY, ORDER).select(*named, SEQ, PRESENT).withColumn(ORDER, F.col(SEQ))
        outcome = "merge" if kind == "merge" else "upsert"
        if stored is None:
            # Nothing to join with: written once, and the outcome is read from what was written.
            rows = merge_update(self._empty(fields), batch, KEY, ORDER, PRESENT, 0) if kind == "merge" else batch
            table = self._store(rows.filter(F.col(KEY).isNotNull()).select(*[s.name for s in fields], SEQ))
            self._publish(use_backup, table)
            lost = long.filter(F.col("doc_id").isNull()).select(F.col("doc_id").alias(KEY)).distinct()
            written = self.spark.table(f"{self.database}.{table}").select(KEY).unionByName(lost)
            return mutation_report(self.spark.createDataFrame([], f"{KEY} string"), written, outcome, limit=0)
        batch = staged(batch, f"{self.name}-batch")
        limit = _limit(batch)
        base = evolve(stored, fields)
        if kind == "continue":
            batch = _continued(stored, batch, limit)
        changed = (
            upsert(base, batch.drop(PRESENT), order=ORDER, limit=limit)
            if kind == "upsert"
            else merge_update(base, batch, KEY, ORDER, PRESENT, limit)
        )
        self._publish(use_backup, self._store(changed.select(*base.columns)))
        return mutation_report(stored, batch, outcome, limit=limit)


def _limit(batch: DataFrame) -> int | None:
    """The answer to "is it small", measured once for all joins with a batch."""
    return None if measured_bytes(batch) <= BROADCAST_LIMIT_BYTES else 0


def _continued(stored: DataFrame, batch: DataFrame, limit: int | None) -> DataFrame:
    """``batch`` with all fields marked as supplied, but for documents that go on with the stored one."""
    mine = broadcast_if_small(batch.select(KEY, SEQ), limit)
    same = broadcast_if_small(stored.select(KEY, SEQ).join(mine, [KEY, SEQ], "left_semi"), limit)
    every = F.array(*[F.lit(c) for c in batch.columns if c not in (KEY, ORDER, PRESENT)])
    marked = batch.join(same.withColumn("__same", F.lit(True)), [KEY, SEQ], "left")
    present = F.when(F.col("__same"), F.col(PRESENT)).otherwise(every)
    return marked.withColumn(PRESENT, present).select(*batch.columns)
