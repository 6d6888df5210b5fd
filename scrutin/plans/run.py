"""L2: the staged batch run (collect -> process -> summarise -> analyze -> train -> charts).

Each stage is one lazy plan ended by one write; the next stage reads the
written table.  The hand-over through stored tables also bounds lineage, so
a lost executor only recomputes the current stage.  The raw and the processed
table carry a manifest (``sources/stages.py``): a stored stage is used only if
it is whole and was made from the stored input.  ``out_dir`` must be
shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.functions import exprs as X
from scrutin.operators import aggregates as A
from scrutin.operators import clean
from scrutin.operators import enrich as E
from scrutin.operators import ml as M
from scrutin.plans import analyze as L4
from scrutin.plans import preprocess as L1
from scrutin.plans import summaries
from scrutin.sources import files
from scrutin.sources import stages as stage_tables

STAGES = ("collect", "process", "summarise", "analyze", "train", "charts")


#: The raw table's partition column: the year as a number, null for a bad one.
RAW_YEAR = "stage_year"


def _year(df: DataFrame) -> Column:
    typed = clean.rename_synonyms(df)
    return X.to_int(df[df.columns[typed.columns.index(S.YEAR)]]) if S.YEAR in typed.columns else F.lit(None).cast("int")


def _years(df: DataFrame) -> list[int]:
    """The valid years that occur: as many as the validation allows at most."""
    rows = df.select(_year(df).alias("y")).where(F.col("y").between(S.MIN_YEAR, S.MAX_YEAR)).distinct().collect()
    return sorted(r.y for r in rows)


def run(spark: SparkSession, source: DataFrame | None, out_dir: str, stages: Sequence[str] = STAGES,
        tiebreak: Sequence[str] | None = None, keys: Sequence[str] | None = None, update: bool = False) -> dict[str, str]:
    """Run the requested stages in order; returns stage -> written path.

    ``source`` is what the first stage works on.  Without it, processing
    starts from the stored raw table.  ``update`` rewrites only the years that
    the source has, in the raw and in the processed table (deduplication is
    by year, so a year's rows depend on no other year); the analyses then see
    all years.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    if "collect" in stages and source is None:
        raise ValueError("collect needs source rows")
    paths = {"collect": f"{out_dir}/raw", "process": f"{out_dir}/processed", "summarise": f"{out_dir}/summary",
             "analyze": f"{out_dir}/analysis", "train": f"{out_dir}/models", "charts": f"{out_dir}/charts"}
    done: dict[str, str] = {}
    years = _years(source) if update and source is not None else []
    raw_before = stage_tables.manifest(spark, paths["collect"])
    processed_before = stage_tables.manifest(spark, paths["process"])
    if "collect" in stages:
        stage_tables.write_stage(source.withColumn(RAW_YEAR, _year(source)), paths["collect"], partition_by=[RAW_YEAR], update=update, emptied=years)
        done["collect"] = paths["collect"]
    part = update and source is not None and processed_before is not None
    if "process" in stages:
        if "collect" in stages or source is None:
            made_from = stage_tables.checked(spark, paths["collect"]).identity
            raw = stage_tables.read_stage(spark, paths["collect"])
            # the other years stand only if they were made from the raw table as it was
            part = part and raw_before is not None and processed_before.made_from == raw_before.identity
            raw = (raw.where(F.col(RAW_YEAR).isin(years)) if part else raw).drop(RAW_YEAR)
        else:
            raw, made_from = source, stage_tables.GIVEN
        processed = L1.preprocess(raw, tiebreak=tiebreak, sort=False)
        stage_tables.write_stage(processed, paths["process"], partition_by=[S.YEAR], made_from=made_from, update=part, emptied=years)
        done["process"] = paths["process"]
    processed_path = paths["process"]

    def processed_rows() -> DataFrame:
        """The processed table; if it was made from the raw table, from the stored one."""
        m = stage_tables.checked(spark, processed_path)
        if m.made_from != stage_tables.GIVEN:
            stage_tables.checked(spark, processed_path, stage_tables.checked(spark, paths["collect"]).identity)
        return stage_tables.read_stage(spark, processed_path)

    if "summarise" in stages:
        rows, made_from = processed_rows(), stage_tables.checked(spark, processed_path).identity
        stored = stage_tables.manifest(spark, paths["summarise"])
        stands = part and "process" in stages and stored is not None and stored.made_from == processed_before.identity
        summaries.write(rows, paths["summarise"], made_from, years if stands else None)
        done["summarise"] = paths["summarise"]
    if "analyze" in stages:
        # merged from the summary if it is that of the processed table
        stored = stage_tables.manifest(spark, paths["summarise"])
        rows = processed_rows()
        if stored is not None and stored.made_from == stage_tables.checked(spark, processed_path).identity:
            rows = summaries.read(spark, paths["summarise"], stored.made_from)
        done["analyze"] = files.write_table(L4.analyze(rows), paths["analyze"])
    if "train" in stages:
        rows = processed_rows()
        # without a row key the split hashes all columns
        results, artifacts = M.train_and_select(rows, keys or tiebreak or rows.columns)
        if artifacts["models"]:
            M.save_models(artifacts, results, paths["train"])
        else:
            files.write_table(results, f"{paths['train']}/results")
        done["train"] = paths["train"]
    if "charts" in stages:
        p = processed_rows()
        by_dept = A.by_department(p)
        tables = {"by_department": by_dept, "by_year": A.by_year(p),
                  "label_evolution": A.label_evolution(p), "correlations": A.correlation_matrix(
                      p, [c for c in ("taux_participation", "taux_abstention", "pct_exprimes", "pct_inscrits",
                                      "voix", "inscrits", "votants") if c in p.columns]),
                  "map_points": E.with_map_point(by_dept)}
        for name, df in tables.items():
            files.write_table(df, f"{paths['charts']}/{name}")
        done["charts"] = paths["charts"]
    return done
