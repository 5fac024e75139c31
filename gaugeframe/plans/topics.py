"""Health topics, and the jobs that run one or all of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.numbers import data_error, whole_year
from gaugeframe.operators.bloom import keep_possible
from gaugeframe.operators.facts import indicators_without_data, observations_for, repeat_rows
from gaugeframe.operators.joins import BROADCAST_BYTES, join_on_key, measured_bytes
from gaugeframe.operators.reshape import (
    NullPolicy,
    clean_long,
    mark_missing,
    mean_cells,
    pivot_wide,
    prune,
    rename,
)
from gaugeframe.operators.selection import select_by_topic, select_indicators
from gaugeframe.schemas import CODE, NEEDED, VALUE, YEAR
from gaugeframe.sources.landing import OnError, OnMissing, ensure_complete, fail_on_error, scan_catalog, scan_observations
from gaugeframe.storage import cut_lineage

ENTITY = "ENTITY"


@dataclass(frozen=True)
class Topic:
    """Parameters of one topic; without terms the topic's own name is the term."""

    name: str
    terms: tuple[str, ...] = ()
    entity: str = "COUNTRY"
    null_policy: NullPolicy = "keys"
    on_error: OnError = "skip"
    catalog_on_error: OnError = "fail"
    on_missing: OnMissing = "none"

    @property
    def patterns(self) -> tuple[str, ...]:
        return self.terms or (self.name.replace("_", " "),)


# Topics with their search terms, entity columns and policies.
# Spellings, repeated terms and regular-expression groups belong to the values.
TOPICS = (
    Topic(
        "alcohol",
        ("Alcohol", "alcoholic beverage", "first drink", "Alcohol-attributable"),
        on_error="fail",
    ),
    Topic(
        "antimicrobial_resistance",
        ("AMR", "GLASS", "national reference laboratory", "NCC", "Antimicrobial Susceptibility Testing"),
        entity="REGION",
        null_policy="value",
    ),
    Topic("dementia"),
    Topic("electricity_supply"),
    Topic(
        "environment_and_health",
        (
            "Lead paint",
            "Poisoning (unintentional)",
            "Diarrhoea",
            "Water-, sanitation",
            "Cooking fuels",
            "Environment attributable",
            "Environment-attributable",
            "Sunbed regulations",
            "UV radiation",
            "Solar ultraviolet",
            "Air pollution",
            "Second-hand smoke",
            "Beverage tax",
            "Electrification of health-care facilities",
            "Deaths attributable to the environment",
            "Occupational airborne",
            "Occupational noise",
            "Occupational injuries",
            "Occupatinal ergonomic",
            "Occupational carcinogens",
            "Radon",
            "WASH",
            "Wastewater flows",
            "Electromagentic fields",
            "Electric field",
        ),
        entity="COUNTRY/REGION",
    ),
    Topic(
        "dementia_observatory",
        (
            "Dementia inclusion risk reduction",
            "Dementia: implementation level",
            "Cholesterol, mean total",
            "Physical activity",
            "Obesity among adults",
            "Hypertension among adults",
            "Overweight among adults",
            "Alcohol, total per capita",
            "Depression, population-based prevalence",
            "Dementia national plan",
            "Dementia inclusion",
            "Dementia plans",
            "Inclusion of human rights as a guiding principle of the dementia plan",
            "Dementia plan",
            "Dementia: legislation",
            "Percentage of sub-national regions covered by dementia",
            "Dementia sub-national plan(s)",
            "Dementia care",
            "Dementia facilities",
            "Dementia paliative",
            "Dementia diagnostic",
            "Dementia standards",
            "Dementia workforce",
            "Psychiatrists working in mental health sector",
            "Dementia psychosocial",
            "Dementia training",
            "Dementia: Adult day centres",
            "Dementia nongovernmental organization",
            "Pharmacists",
            "Medical doctors",
            "Nursing and midwifery personnel",
            "Dementia diagnosis",
            "Dementia assistive technology",
            "Dementia treatment",
            "Beds, hospital beds",
            "Health infrastructure",
            "Dementia research",
            "Demential integrated",
            "Dementia iplementation",
            "Dementia carer",
            "Dementia campaign",
            "Dementia-friendly",
            "Dementia routine monitoring",
            "Dementia reporting",
        ),
        entity="COUNTRY/REGION",
    ),
    Topic("hiv"),
    Topic(
        "health_systems",
        (
            "density per 100 000 population",
            "median availability of selected generic medicines",
            "median consumer price ratio of selected generic medicines",
            "care-seeking by type of patient and source of care",
            "beds, hospital beds",
        ),
    ),
    Topic(
        "health_workforce",
        (
            "mental health sector",
            "biomedical engineers",
            "biomedical technicians",
            "qualified actively working",
            "nursing personnel",
            "midwifery personnel",
            "pharmacists",
            "medical doctors",
            "medical practicioners",
            "dentists",
            "dental assistants",
            "environmental and occupational health",
            "community health workers",
            "dental prosthetic technicians",
            "medicine professionals",
        ),
    ),
    Topic(
        "life_expectancy",
        (
            "child deaths",
            "adolescent mortality rate",
            "child mortality",
            "stillbirth rate",
            "Adult mortality",
            "Poisoning (unintentional)",
            "Suicide rates",
            "NCD deaths",
            "Dying between the exact ages",
            "Life expectancy",
            "Road traffic deaths",
            "Road traffic death rateHomicides",
            "Maternal deaths",
            "Maternal mortality",
        ),
    ),
    Topic("malaria"),
    Topic(
        "maternal_health",
        (
            "births delivered in a health facility",
            "Births by caesarean section",
            "Adolescent birth rate",
            "Family planning",
            "Antenatal care coverage",
            "anaemia in pregnant women",
            "anaemia in women of reproductive age",
            "Births attended by skilled health personnel",
            "Maternal mortality ratio",
        ),
    ),
    Topic("buruli"),
    Topic("leishmaniasis"),
    Topic("leprosy"),
    Topic("onchocerciasis"),
    Topic("rabies"),
    Topic("taeniasis", ("pigs",)),
    Topic("trachoma"),
    Topic("trypanosomiasis"),
    Topic("yaws"),
    Topic(
        "noncommunicable_diseases",
        (
            "overweight among children",
            "overweight among adults",
            "underweight among adults",
            "thinness among children",
            "obesity among children",
            "tobacco use",
            "Tobacco MPOWER",
            "Diabetes",
            "Physicial activity",
            "Hypertension",
            "Cholesterol",
            "NCD Country Capacity",
            "Cancer diagnosis and treatment",
            "Cervical cancer screening",
            "Palliative care",
            "Vision and eyecare",
            "Suicide rates",
            "Cardiovascular diseases, cancer, diabetes",
            "NCD",
        ),
    ),
    Topic("oral_health", ("Dentists", "Oral health", "Dental", "oral health")),
    Topic("patient_safety", entity="COUNTRY/REGION"),
    Topic("pollution"),
    Topic("substance_use_disorders"),
    Topic(
        "universal_health_coverage",
        ("Financial hardship", "UHC Service Coverage"),
        entity="COUNTRY/REGION",
    ),
    Topic(
        "violence_against_women",
        ("intimate partner violence", "non-partner sexual violence prevalence"),
    ),
    Topic(
        "health_statistics",
        (
            "Diarrhoea",
            "Water-, santitation- and hygiene",
            "Impoverishing health spending",
            "Households impoverished",
            "Households with out-of-pocket payments",
            "Catastrophic health spending",
            "Households pushed below or further below a relative poverty line",
            "NCD country capacity",
            "General availability of",
            "Availability of cardiovascular risk stratifcation",
            "Cancer diagnosis and treatment services",
            "Physical activity",
            "Hypertension",
            "Overweight among children",
            "Obesity among adults",
            "Underweight among adults",
            "Overweight among adults",
            "Cholesterol",
            "Paliative care",
            "Beverage tax",
            "Thinness among children",
            "Diabetes",
            "NCD deaths",
            "Suicide rates",
            "Dying between the exact ages",
            "Vision and eyecare",
            "Nursing personnel",
            "Midwifery personnel",
            "Medical doctors",
            "Medical and Pathology Laboratory",
            "Pharmacists",
            "Pharmaceutical Technicians",
            "Physiotherapists",
            "Physiotherapy",
            "Community health workers",
            "Environmental and Occupational Health",
            "Dentists",
            "Dental Assistants and Therapists",
            "Dental Prothetic Technicians",
            "Traditional and complementary medicine",
            "HIV",
            "Mental Health",
            "Health expenditure",
            "Out-of-pocket expenditure",
            "Child deaths",
            "Child mortality",
            "Adolescent mortality rate",
            "Life expectancy",
            "WASH",
            "Yellow Fever",
            "Measles",
            "Rubella",
            "Tetanus",
            "Mumps",
            "Diphtheria",
            "Poliomyelitis",
            "Rotavirus vaccines",
            "immunization coverage",
            "Vaccination cards",
            "Japanese encephalitis",
            "Pertussis",
            "Congenital rubella syndrome",
            "Stunting",
            "Wasting",
            "Overweight prevalence",
            "Maternal mortality ratio",
            "Births attended by skilled health personnel",
        ),
    ),
)


def topic_named(name: str, topics: Sequence[Topic] = TOPICS) -> Topic:
    """The topic of that name."""
    found = [t for t in topics if t.name == name]
    if not found:
        raise KeyError(f"no topic {name!r}; there are {[t.name for t in topics]}")
    return found[0]


@dataclass(frozen=True)
class TopicTables:
    """Results of one topic; nothing is computed before a table is asked for.

    ``wide`` needs its columns: without ``keys`` the means are then stored and their
    columns looked up.  ``without_data`` are the selected indicators without observations.
    """

    selection: DataFrame
    collected: DataFrame
    topic: Topic
    keys: Sequence[tuple[str, int]] | None = None
    scale: int | None = None
    max_columns: int | None = None

    @cached_property
    def long(self) -> DataFrame:
        return clean_long(self.collected, self.topic.entity, self.topic.null_policy)

    @cached_property
    def cells(self) -> DataFrame:
        return mean_cells(self.long, self.topic.entity, self.scale)

    @cached_property
    def wide(self) -> DataFrame:
        return pivot_wide(self.cells, self.topic.entity, self.keys, self.max_columns)

    @cached_property
    def without_data(self) -> DataFrame:
        return indicators_without_data(self.selection, self.collected)


def run_topic(
    catalog: DataFrame,
    observations: DataFrame,
    topic: Topic,
    keys: Sequence[tuple[str, int]] | None = None,
    scale: int | None = None,
    dedupe: bool = False,
    max_columns: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> TopicTables:
    """Select, collect, clean, average and pivot for one topic."""
    selection = select_indicators(catalog, topic.patterns)
    chosen = observations_for(prune(observations), selection, dedupe, broadcast_bytes)
    return TopicTables(selection, chosen, topic, keys, scale, max_columns)


def run_landed_topic(
    landed_catalog: DataFrame,
    landed_observations: DataFrame,
    topic: Topic,
    keys: Sequence[tuple[str, int]] | None = None,
    scale: int | None = None,
    max_columns: int | None = None,
    allow_missing_pages: bool = False,
) -> TopicTables:
    """As ``run_topic``, from landed pages.

    Pages that are linked but not landed are an error unless they are allowed.  Only pages
    of selected codes are parsed, and only these can fail the run.
    """
    if not allow_missing_pages:
        ensure_complete(landed_catalog)
    catalog = scan_catalog(landed_catalog, topic.catalog_on_error, on_missing=topic.on_missing)
    selection = select_indicators(catalog, topic.patterns)
    pages = observations_for(landed_observations, selection, key="code")
    if not allow_missing_pages:
        ensure_complete(pages)
    rows = scan_observations(pages, topic.on_error, on_missing=topic.on_missing)
    return TopicTables(selection, rows, topic, keys, scale, max_columns)


def pages_for_topics(
    catalog: DataFrame,
    landed_observations: DataFrame,
    topics: Sequence[Topic] = TOPICS,
    on_error: OnError | None = None,
    on_missing: OnMissing | None = None,
) -> DataFrame:
    """The landed pages of all codes that some topic selects, before any body is parsed.

    ``strict`` marks pages that stop the job if they failed, ``strict_rows`` those that do so if they
    have no rows, since a topic that selects their code asks for that; ``on_error`` and
    ``on_missing`` hold for all topics instead.
    """
    chosen = select_by_topic(catalog, {t.name: t.patterns for t in topics})

    def asked(policies: dict[str, str]) -> Column:
        return F.max(F.col("topic").isin([name for name, policy in policies.items() if policy == "fail"]))

    strict = asked({t.name: on_error or t.on_error for t in topics}).alias("strict")
    strict_rows = asked({t.name: on_missing or t.on_missing for t in topics}).alias("strict_rows")
    codes = cut_lineage(chosen.groupBy(F.col(CODE).alias("code")).agg(strict, strict_rows))
    codes = codes.filter(F.length("code") >= 0)
    small = measured_bytes(codes) <= BROADCAST_BYTES
    near = landed_observations if small else keep_possible(landed_observations, codes, "code")
    return join_on_key(near, codes, "code", small=small)


def accepted_pages(pages: DataFrame) -> DataFrame:
    """``pages_for_topics`` without failed pages, or with an error at those that are ``strict``."""
    return fail_on_error(pages.filter((F.col("status") == 200) | F.col("strict"))).drop("strict")


def stopped_at_failures(pages: DataFrame) -> DataFrame:
    """``pages_for_topics`` with an error at failed pages that are ``strict``; the other failed pages stay."""
    stops = F.coalesce(F.col("status") != 200, F.lit(True)) & F.col("strict")
    status, url = (F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in ("status", "url"))
    body = F.when(stops, data_error("response ", status, " for ", url).cast("string"))
    return pages.withColumn("body", body.otherwise(F.col("body"))).drop("strict")


def landed_for_topics(
    catalog: DataFrame,
    landed_observations: DataFrame,
    topics: Sequence[Topic] = TOPICS,
    on_error: OnError | None = None,
) -> DataFrame:
    """The landed pages of all codes that some topic selects, before any body is parsed.

    A failed page stops the job if a topic that selects its code asks for that, and is left
    out otherwise; ``on_error`` holds for all topics instead.
    """
    return accepted_pages(pages_for_topics(catalog, landed_observations, topics, on_error)).drop("strict_rows")


def _topics_per_code(catalog: DataFrame, topics: Sequence[Topic], dedupe: bool) -> DataFrame:
    """Per code the topics that select it and under how many names.

    One row per code; its array has at most one entry per topic.  Stored, as it
    is measured and joined more than once.  The last filter keeps every row; it
    tells the optimizer that the codes are a choice, so that a join with
    observations stored by code reads the chosen folders only.
    """
    chosen = select_by_topic(catalog, {t.name: t.patterns for t in topics})
    copies = F.lit(1).cast("long") if dedupe else F.count("*")
    counted = chosen.groupBy(CODE, "topic").agg(copies.alias("copies"))
    per_code = counted.groupBy(CODE).agg(F.collect_list(F.struct("topic", "copies")).alias("topics"))
    return cut_lineage(per_code).filter(F.size("topics") > 0)


def _kept_by_policy(rows: DataFrame, topics: Sequence[Topic]) -> DataFrame:
    """Apply to each row the null policy of its topic."""
    by_value = [t.name for t in topics if t.null_policy == "value"]
    by_keys = [t.name for t in topics if t.null_policy == "keys"]
    has_keys = F.col(ENTITY).isNotNull() & F.col(YEAR).isNotNull() & F.col(CODE).isNotNull()
    problem = data_error("observation with a value but without a year").cast("boolean")
    has_value = F.when(F.col(VALUE).isNull(), False).when(F.col(YEAR).isNull(), problem).otherwise(True)
    return rows.filter(
        F.when(F.col("topic").isin(by_keys), has_keys).when(F.col("topic").isin(by_value), has_value)
    )


def all_topics_rows(
    catalog: DataFrame,
    observations: DataFrame,
    topics: Sequence[Topic] = TOPICS,
    dedupe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Raw observations of all topics, marked by ``topic``, from one scan of the observations.

    Rows are copied to their topics after the join, so what is read, and
    shuffled if at all, does not grow with the number of topics.
    """
    lookup = _topics_per_code(catalog, topics, dedupe)
    joined = join_on_key(prune(observations), lookup, CODE, "inner", broadcast_bytes)
    spread = joined.withColumn("t", F.explode("topics")).select("t.topic", "t.copies", *NEEDED)
    return repeat_rows(spread, "copies")


def all_topics_long(
    catalog: DataFrame,
    observations: DataFrame,
    topics: Sequence[Topic] = TOPICS,
    dedupe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Long tables of all topics, marked by ``topic``, each under its own null policy."""
    rows = all_topics_rows(catalog, observations, topics, dedupe, broadcast_bytes)
    kept = _kept_by_policy(rename(mark_missing(rows), ENTITY), topics)
    return kept.select("topic", ENTITY, whole_year(F.col(YEAR)).alias(YEAR), CODE, VALUE)


def all_topics_cells(
    catalog: DataFrame,
    observations: DataFrame,
    topics: Sequence[Topic] = TOPICS,
    scale: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Means of all topics, marked by ``topic``, from one scan of the observations.

    A mean depends on neither topic nor null policy, so every selected code is
    averaged once and the finished means are copied to the topics.
    """
    lookup = _topics_per_code(catalog, topics, dedupe=True)
    small = measured_bytes(lookup) <= broadcast_bytes
    codes = lookup.select(CODE)
    facts = join_on_key(
        prune(observations), codes, CODE, "left_semi", small=small
    )
    cells = mean_cells(clean_long(facts, ENTITY), ENTITY, scale)
    if not small:
        cells = cut_lineage(cells)
    marked = join_on_key(cells, lookup, CODE, "inner", small=small)
    return marked.withColumn("t", F.explode("topics")).select("t.topic", ENTITY, CODE, YEAR, VALUE)


def topic_wide(
    cells: DataFrame,
    topic: Topic,
    keys: Sequence[tuple[str, int]] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """Wide table of one topic from the means of all topics.

    Store the means first when several topics are wanted.
    """
    own = cells.filter(F.col("topic") == topic.name).drop("topic")
    return pivot_wide(own.withColumnRenamed(ENTITY, topic.entity), topic.entity, keys, max_columns)
