"""The run protocol: one row per language and file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.functions.report import RECOMMENDATION_COLUMNS, recommendations
from glossweave.functions.text import non_blank
from glossweave.sources.stages import exists

# Protocol columns in order, and the statistics that fill them.
PROTOCOL_COLUMNS = (
    "Datum", "Datei", "Sprache", "Modell", "Temperatur", "Batchgroesse", "Parallelisierung",
    "Anzahl_API_Calls", "Gesamt_Input_Tokens", "Gesamt_Output_Tokens", "Laufzeit", "Anzahl_Retries",
    "Gesamtzeilen", "Deutsch_Reste_automatisch", "Verdachtsfaelle_gesamt", "Manuell_korrigiert",
    "Neu_uebersetzt", "Endgueltige_Deutsch_Reste", *RECOMMENDATION_COLUMNS,
)
STATISTICS = {
    "Datum": "datum", "Datei": "datei", "Sprache": "sprache", "Modell": "modell", "Temperatur": "temperatur",
    "Batchgroesse": "batchgroesse", "Parallelisierung": "parallelisierung", "Anzahl_API_Calls": "api_calls",
    "Gesamt_Input_Tokens": "input_tokens", "Gesamt_Output_Tokens": "output_tokens", "Laufzeit": "laufzeit",
    "Anzahl_Retries": "retries", "Gesamtzeilen": "gesamtzeilen", "Deutsch_Reste_automatisch": "deutsch_reste_auto",
    "Verdachtsfaelle_gesamt": "verdachtsfaelle_gesamt", "Neu_uebersetzt": "neu_uebersetzt",
    "Endgueltige_Deutsch_Reste": "endgueltige_deutsch_reste",
}
MANUAL_COLUMN = "Manuell_korrigiert"
CARRIED_ROW = (MANUAL_COLUMN,)
CARRIED_POOL = (MANUAL_COLUMN, *RECOMMENDATION_COLUMNS)


def with_recommendations(stats: DataFrame) -> DataFrame:
    """Add the four recommendation texts to run statistics."""
    return stats.withColumns(
        recommendations(
            *[F.col(c) for c in ("sprache", "endgueltige_deutsch_reste", "deutsch_reste_auto", "retries", "api_calls", "input_tokens", "output_tokens")]
        )
    )


def protocol_rows(stats: DataFrame) -> DataFrame:
    """Run statistics as protocol rows, every column text; recommendations if ``stats`` has them."""
    def source(name: str):
        column = STATISTICS.get(name, name)
        return F.coalesce(F.col(column).cast("string"), F.lit("")) if column in stats.columns else F.lit("")

    return stats.select(*[source(c).alias(c) for c in PROTOCOL_COLUMNS])


def upsert_protocol(
    old: DataFrame, new: DataFrame, carried: Sequence[str] = CARRIED_POOL, key: Sequence[str] = ("Datei", "Sprache")
) -> DataFrame:
    """Replace rows of ``old`` by those of ``new`` with the same key, ignoring case, and append the rest.

    A non-blank carried column of a replaced row survives. Old rows without a successor stay.
    """
    names = [f"_key{i}" for i in range(len(key))]
    keys = {n: F.upper(F.col(c)) for n, c in zip(names, key)}
    keyed_old, keyed_new = old.withColumns(keys), new.withColumns(keys)
    # At most one old row should exist per key; should there be more, the smallest text is carried.
    kept = keyed_old.groupBy(*names).agg(
        *[F.min(F.when(non_blank(F.col(c)), F.col(c))).alias(f"_old_{c}") for c in carried]
    )
    replaced = keyed_new.join(kept, names, "left").select(
        *[F.coalesce(f"_old_{c}", c).alias(c) if c in carried else F.col(c) for c in old.columns]
    )
    stayed = keyed_old.join(keyed_new.select(*names), names, "left_anti").select(*old.columns)
    return stayed.unionByName(replaced)


class ProtocolTable:
    """The protocol as a table of versions below ``path``; readers see the last version that was written whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [status.getPath().getName() for status in system.listStatus(root)] if system.exists(root) else []
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def versions(self) -> list[int]:
        """Numbers of the committed versions."""
        return [n for n in self._numbers() if exists(self.spark, f"{self.path}/version={n}/_SUCCESS")]

    def read(self) -> DataFrame:
        schema = ", ".join(f"`{c}` string" for c in PROTOCOL_COLUMNS)
        found = self.versions()
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={found[-1]}") if found else self.spark.createDataFrame([], schema)

    def upsert(self, new: DataFrame, carried: Sequence[str] = CARRIED_POOL, key: Sequence[str] = ("Datei", "Sprache")) -> bool:
        """Write a version with the rows of ``new`` put in; without any there is no new version, and the answer is False.

        A number is used once, also by a writer that failed: of two that write at the same time, the later one is refused.
        """
        if new.isEmpty():
            return False
        number = max(self._numbers(), default=-1) + 1
        merged = upsert_protocol(self.read(), new, carried, key)
        merged.write.mode("errorifexists").parquet(f"{self.path}/version={number}")
        return True
