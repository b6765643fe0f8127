"""The whole conversion: source tables and vocabulary in, target tables and review rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions.text import has_code
from clinloom.operators import vocab
from clinloom.operators.ids import Cells, Numbered, dense_ids
from clinloom.operators.lookups import lookup_side
from clinloom.plans import cost, dims, facts, payer, review, visits
from clinloom.staging import StageStore


class CdmBuild:
    """Plans of one run. Each table is built on first use and shared by those that need it."""

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        concept: DataFrame,
        relationship: DataFrame,
        as_of: Column | None = None,
        store: StageStore | None = None,
    ):
        self.sources = sources
        self.concept = concept
        self.relationship = relationship
        self.as_of = F.current_date() if as_of is None else as_of
        self.spark: SparkSession = concept.sparkSession
        self.store = store or StageStore(self.spark)
        self._apart: dict[str, StageStore] = {}
        self._counted: dict[str, int] = {}

    # --- numbered dimensions -------------------------------------------------------

    def _number(self, source: str, id_column: str) -> Numbered:
        return dense_ids(self.sources[source], id_column, ["Id"], self.store)

    @cached_property
    def patients(self) -> Numbered:
        return self._number("patients", "person_id")

    @cached_property
    def organizations(self) -> Numbered:
        return self._number("organizations", "care_site_id")

    @cached_property
    def providers(self) -> Numbered:
        return self._number("providers", "provider_id")

    @cached_property
    def visit_stage(self) -> Numbered:
        stage = visits.visit_stage(
            self.sources["encounters"], self.patients, self.providers, self.organizations, self.as_of
        )
        return visits.number_visits(stage, self.store, self._person_cells("visit_occurrence"))

    @cached_property
    def death_stage(self) -> DataFrame:
        return dims.death_stage(self.patients, self.as_of)

    # --- lookups -------------------------------------------------------------------

    @cached_property
    def concept_lookup(self) -> DataFrame:
        return self.store.save(vocab.concept_lookup(self.concept, self.relationship), "concept_lookup")

    @cached_property
    def concept_keys(self) -> DataFrame:
        return self.store.save(vocab.concept_keys(self.sources), "concept_keys")

    @cached_property
    def concept_sides(self) -> vocab.ConceptSides:
        return vocab.ConceptSides(self.concept_lookup, lambda: self.concept_keys, self.store)

    @cached_property
    def concept_map(self) -> DataFrame:
        rows = sum(self.concept_sides.rows.values())
        return vocab.concept_map(self.concept_keys, lookup_side(self.concept_lookup, rows))

    @cached_property
    def visit_ids(self) -> DataFrame:
        side = visits.valid_visits(self.visit_stage).select(
            "encounter_source_id",
            "visit_occurrence_id",
            F.col("provider_id").alias("visit_provider_id"),
            "visit_start_date",
            "visit_start_datetime",
        )
        return lookup_side(side, self.visit_stage.rows)

    @cached_property
    def links(self) -> facts.Links:
        return facts.Links(
            persons=visits.person_side(self.patients),
            visits=self.visit_ids,
            providers=visits.provider_side(self.providers),
            concepts=self.concept_sides,
            as_of=self.as_of,
        )

    # --- numbered facts ------------------------------------------------------------

    def _own_store(self, stage: str) -> StageStore:
        """A folder of its own, so that one stage table can go without the others."""
        self._apart[stage] = StageStore(self.spark, self.store.folder, self.store.compression)
        return self._apart[stage]

    def _person_cells(self, table: str) -> Cells:
        """How the rows of a fact table lie along its person ids, estimated from a sample of its sources' patients.

        It only sets how large the tasks are that sort the rows; every row is read and numbered.
        """
        persons, names = max(1, self.patients.rows), FACT_SOURCES[table]
        cells = min(PERSON_CELLS, persons)
        cell = F.expr(f"(person_id - 1) * {cells} div {persons}")
        fraction = min(1.0, SAMPLED_ROWS / max(1, sum(self._source_rows(name) for name in names)))
        parts = []
        for name in names:
            patient, rows = ("PATIENTID", _diagnoses()) if name == "claims" else ("PATIENT", F.lit(1))
            parts.append(self.sources[name].select(F.col(patient).alias("Id"), rows.alias("_rows")).sample(fraction, seed=1))
        found = self.patients.df.select("Id", "person_id").join(F.broadcast(reduce(DataFrame.unionByName, parts)), "Id")
        # one row per cell
        rows = dict(found.groupBy(cell.cast("int")).agg(F.sum("_rows")).collect())
        return Cells(cell, [rows.get(n, 0) / fraction for n in range(cells)])

    def _source_rows(self, name: str) -> int:
        if name not in self._counted:
            self._counted[name] = self.sources[name].count()
        return self._counted[name]

    def _number_facts(self, stage: DataFrame, table: str) -> DataFrame:
        order = [*facts.FACT_ORDER[table], "source_row_id"]
        return dense_ids(stage, S.PRIMARY_KEYS[table], order, self._own_store(STAGES_OF[table][0]), cells=self._person_cells(table)).df

    @cached_property
    def condition_stage(self) -> DataFrame:
        stage = facts.condition_stage(self.sources["conditions"], self.sources["claims"], self.links)
        return self._number_facts(stage, "condition_occurrence")

    @cached_property
    def procedure_stage(self) -> DataFrame:
        names = ("procedures", "careplans", "imaging_studies")
        stage = facts.procedure_stage(*(self.sources[n] for n in names), self.links)
        return self._number_facts(stage, "procedure_occurrence")

    @cached_property
    def drug_stage(self) -> DataFrame:
        stage = facts.drug_stage(self.sources["medications"], self.sources["immunizations"], self.links)
        return self._number_facts(stage, "drug_exposure")

    @cached_property
    def routed_observations(self) -> DataFrame:
        routed = facts.observation_links(self.sources["observations"], self.links)
        return self._own_store("routed_observations").save(routed, "routed_observations")

    @cached_property
    def measurement_stage(self) -> DataFrame:
        return self._number_facts(facts.measurement_stage(self.routed_observations, self.links), "measurement")

    @cached_property
    def observation_stage(self) -> DataFrame:
        stage = facts.observation_stage(self.routed_observations, self.sources["allergies"], self.links)
        return self._number_facts(stage, "observation")

    @cached_property
    def device_stage(self) -> DataFrame:
        stage = facts.device_stage(self.sources["devices"], self.sources["supplies"], self.links)
        return self._number_facts(stage, "device_exposure")

    @cached_property
    def payer_plan_stage(self) -> DataFrame:
        names = self.store.save(payer.payer_map(self.sources["payers"], self.concept), "payer_map")
        names = lookup_side(names, names.count())
        stage = payer.payer_stage(self.sources["payer_transitions"], names, self.links)
        return self._number_facts(stage, "payer_plan_period")

    # some columns of long rows, so that the costs do not have to wait with all of them
    @cached_property
    def procedure_costs(self) -> DataFrame:
        return self._own_store("procedure_costs").save(cost.procedure_costs(self.procedure_stage), "procedure_costs")

    @cached_property
    def drug_costs(self) -> DataFrame:
        return self._own_store("drug_costs").save(cost.drug_costs(self.drug_stage), "drug_costs")

    @cached_property
    def cost_table(self) -> DataFrame:
        stage = cost.cost_stage(
            self.visit_stage.df,
            self.procedure_costs,
            self.drug_costs,
            self.sources["claims_transactions"],
            self.visit_ids.select("encounter_source_id", "visit_occurrence_id"),
        )
        numbered = dense_ids(stage, "cost_id", ["cost_domain_id", "cost_event_id"], self._own_store("cost_table")).df
        return numbered.select(*S.TARGETS["cost"].fieldNames())

    @cached_property
    def observation_period(self) -> DataFrame:
        return visits.observation_period(visits.valid_visits(self.visit_stage), self._own_store("observation_period"))

    def prepare(self, workers: int = 4) -> None:
        """Build all stages, those that do not need each other side by side.

        Spark runs the jobs of several threads at once, so the last tasks of one
        stage table do not leave the other executors idle.
        """
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(lambda name: getattr(self, name), ("patients", "organizations", "providers", "concept_sides")))
            self.links  # noqa: B018 - builds the visits
            apart = ("drug_stage", "procedure_stage", "condition_stage", "device_stage", "routed_observations", "payer_plan_stage", "observation_period")
            list(pool.map(lambda name: getattr(self, name), apart))
            list(pool.map(lambda name: getattr(self, name), ("cost_table", "measurement_stage", "observation_stage")))

    @staticmethod
    def order(tables: Iterable[str]) -> list[str]:
        """Target tables in the order in which they are best built: dimensions and visits, then as in ``STAGES_OF``."""
        order = [*STAGES_OF]
        return sorted(tables, key=lambda name: order.index(name) if name in order else -1)

    def in_turn(self, tables: Iterable[str]) -> Iterator[str]:
        """Target tables in ``order``, for work on one after another.

        A stage table that is built meanwhile goes as soon as no table of the
        rest reads it, so the disk holds a few of them, not all. Those that
        were there before stay.
        """
        kept, waiting = set(self.__dict__), self.order(tables)
        while waiting:
            yield waiting.pop(0)
            needed = {stage for name in waiting for stage in STAGES_OF.get(name, ())}
            for narrow, stage in (("procedure_costs", "procedure_stage"), ("drug_costs", "drug_stage")):
                if narrow in needed and stage in self.__dict__:
                    getattr(self, narrow)
            for stage in self._apart.keys() - needed - kept:
                self.__dict__.pop(stage, None)
                self._apart.pop(stage).drop()

    def report(self, of_table: Callable[[str], DataFrame], tables: Iterable[str] = S.TARGET_TABLES) -> DataFrame:
        """The rows of ``of_table`` for all tables, worked out table by table (see ``in_turn``); a few rows each."""
        found, schema = {}, None
        for name in self.in_turn(tables):
            rows = of_table(name)
            found[name], schema = rows.collect(), schema or rows.schema
        return self.spark.createDataFrame([row for name in tables for row in found[name]], schema)

    # --- outputs -------------------------------------------------------------------

    def stage(self, table: str) -> DataFrame:
        """The staged rows of a table that has review rules."""
        return {
            "death": lambda: self.death_stage,
            "visit_occurrence": lambda: self.visit_stage.df,
            "condition_occurrence": lambda: self.condition_stage,
            "procedure_occurrence": lambda: self.procedure_stage,
            "drug_exposure": lambda: self.drug_stage,
            "measurement": lambda: self.measurement_stage,
            "observation": lambda: self.observation_stage,
            "device_exposure": lambda: self.device_stage,
            "payer_plan_period": lambda: self.payer_plan_stage,
        }[table]()

    def table(self, name: str) -> DataFrame:
        """One target table."""
        if name == "location":
            return dims.location(self.patients, self.organizations)
        if name == "person":
            return dims.person(self.patients, self.organizations)
        if name == "care_site":
            return dims.care_site(self.organizations)
        if name == "provider":
            return dims.provider(self.providers, self.organizations)
        if name == "visit_occurrence":
            return visits.visit_occurrence(self.visit_stage)
        if name == "observation_period":
            return self.observation_period
        if name == "cost":
            return self.cost_table
        return facts.loaded_rows(self.stage(name), name)

    def review(self) -> DataFrame:
        """Every held row of every stage, without a review id."""
        return reduce(DataFrame.unionByName, map(self.review_of, S.REVIEWED_TABLES))

    def review_of(self, table: str) -> DataFrame:
        """The held rows of one stage."""
        number = None if table == "death" else F.col(S.PRIMARY_KEYS[table])
        return review.review_rows(self.stage(table), table, number)

    # --- counts --------------------------------------------------------------------

    def load_counts(self) -> DataFrame:
        """Rows per target table, and the review rows."""

        def of_table(name: str) -> DataFrame:
            counts = [(name, self.table(name))]
            if name in S.REVIEWED_TABLES:
                counts.append((S.REVIEW_TABLE, self.review_of(name).where(F.col("source_row_id").startswith(S.REVIEW_PREFIX))))
            return reduce(
                DataFrame.unionByName,
                (df.agg(F.count("*").alias("rows_loaded")).select(F.lit(n).alias("table_name"), "rows_loaded") for n, df in counts),
            )

        return self.report(of_table).groupBy("table_name").agg(F.sum("rows_loaded").alias("rows_loaded"))

    def source_counts(self) -> DataFrame:
        return table_counts({name: self.sources[name] for name in S.SOURCE_TABLES})

    def summary(self) -> DataFrame:
        """Totals of the run: sources and rows read, tables and rows loaded, rows held."""

        def metric(df: DataFrame, name: str, value: Column) -> DataFrame:
            return df.agg(F.coalesce(value, F.lit(0)).cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")

        # counted once; two small tables
        read, written = self.store.save(self.source_counts(), "source_counts"), self.store.save(self.load_counts(), "load_counts")
        tables = written.where(F.col("table_name") != S.REVIEW_TABLE)
        held = written.where(F.col("table_name") == S.REVIEW_TABLE)
        parts = [
            metric(read, "source_tables_checked", F.count("*")),
            metric(read, "source_rows_checked", F.sum("row_count")),
            metric(tables, "tables_loaded", F.count("*")),
            metric(tables, "rows_loaded", F.sum("rows_loaded")),
            metric(held, "review_rows", F.sum("rows_loaded")),
        ]
        return reduce(DataFrame.unionByName, parts)

    def dropped_rows(self) -> DataFrame:
        """Per fact source: rows read, staged, held and loaded, and those that went nowhere."""

        def of_table(table: str) -> DataFrame:
            stage = self.stage(table)
            source = F.col("source_table") if "source_table" in stage.columns else F.lit(FACT_SOURCES[table][0])
            return stage.groupBy(source.alias("source_table")).agg(
                F.count("*").alias("rows_staged"),
                F.count("review_reason").alias("rows_held"),
            )

        staged = self.report(of_table, FACT_SOURCES).groupBy("source_table").agg(
            F.sum("rows_staged").alias("rows_staged"), F.sum("rows_held").alias("rows_held")
        )
        read = [
            self.sources[name].agg(F.count("*").alias("rows_read")).select(F.lit(name).alias("source_table"), "rows_read")
            for name in sorted({n for names in FACT_SOURCES.values() for n in names} - {"claims"})
        ]
        read.append(
            self.sources["claims"].agg(F.coalesce(F.sum(_diagnoses()), F.lit(0)).alias("rows_read")).select(
                F.lit("claims").alias("source_table"), "rows_read"
            )
        )
        joined = reduce(DataFrame.unionByName, read).join(staged, "source_table", "left").fillna(0)
        return joined.select(
            "source_table",
            "rows_read",
            "rows_staged",
            "rows_held",
            (F.col("rows_staged") - F.col("rows_held")).alias("rows_loaded"),
            (F.col("rows_read") - F.col("rows_staged")).alias("rows_dropped"),
        )


#: The stage tables that target tables are made of, besides dimensions and visits, and the order to build them in: costs
#: follow procedures and drugs, which they read.
STAGES_OF = {
    "observation_period": ("observation_period",),
    "procedure_occurrence": ("procedure_stage",),
    "drug_exposure": ("drug_stage",),
    "cost": ("cost_table", "procedure_costs", "drug_costs"),
    "condition_occurrence": ("condition_stage",),
    "device_exposure": ("device_stage",),
    "measurement": ("measurement_stage", "routed_observations"),
    "observation": ("observation_stage", "routed_observations"),
    "payer_plan_period": ("payer_plan_stage",),
}

FACT_SOURCES = {
    "visit_occurrence": ("encounters",),
    "condition_occurrence": ("conditions", "claims"),
    "procedure_occurrence": ("procedures", "careplans", "imaging_studies"),
    "drug_exposure": ("medications", "immunizations"),
    "measurement": ("observations",),
    "observation": ("observations", "allergies"),
    "device_exposure": ("devices", "supplies"),
    "payer_plan_period": ("payer_transitions",),
}


#: Cells of the person ids, and rows of a table's sources that are looked at to fill them.
PERSON_CELLS = 4096
SAMPLED_ROWS = 100_000


def _diagnoses() -> Column:
    """The filled diagnosis slots of a claim."""
    return reduce(lambda a, b: a + b, (F.coalesce(has_code(c).cast("int"), F.lit(0)) for c in vocab.DIAGNOSES))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ),
    )
