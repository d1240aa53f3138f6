"""Settings of a run: sources, and the models trained on each."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ModelSettings:
    """One model over one scope; topics run from start to end (exclusive) by the increment."""

    group_column: str | None = None
    group_value: str | None = None
    predict_by_column: str = "stopwords_removed"
    n_gram: int = 1
    no_above: float = 1.0
    no_below: int = 8
    keep_n: int | None = None
    random_state: int = 1
    lda_sample_size: int | None = None
    lda_num_topics_start: int = 10
    lda_num_topics_end: int = 11
    lda_num_topics_increment: int = 1
    lda_updates_per_pass: int = 2
    lda_passes: int = 50
    lda_alpha: str | float = "asymmetric"
    lda_eta: str | float | None = None
    lda_minimum_probability: float = 0.005
    words_per_topic: int = 100
    model_comment: str = "No comment found"

    def topic_counts(self) -> range:
        return range(self.lda_num_topics_start, self.lda_num_topics_end, self.lda_num_topics_increment)


@dataclass(frozen=True)
class SourceSettings:
    """Where the text comes from and what is trained on it."""

    target_column: str
    target_column_id: str
    models: tuple[ModelSettings, ...]
    query: str | None = None
    passthrough: tuple[str, ...] = ()
    remove_stopwords: bool = True
    add_features: bool = False
    collocations: bool = True
    full_clean: bool = False
    only_best: bool = True

    def n_grams(self) -> list[int]:
        """The lengths of runs that the models ask for; texts are prepared once for each."""
        return sorted({m.n_gram for m in self.models})

    def preparation(self, n_gram: int) -> dict[str, object]:
        """What decides how a text becomes tokens; a model is served with the same."""
        names = ("remove_stopwords", "add_features", "collocations", "full_clean")
        return {"n_gram": n_gram} | {name: getattr(self, name) for name in names}


# fixed values: names of the settings in a nested configuration
NESTED_NAMES = {"GroupColumn": "group_column", "GroupValue": "group_value"}


def _known(kind: type, values: Mapping[str, object]) -> dict[str, object]:
    renamed = {NESTED_NAMES.get(k, k): v for k, v in values.items()}
    allowed = {f.name for f in fields(kind)}
    unknown = set(renamed) - allowed
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return renamed


def from_nested(config: Mapping[object, Mapping[str, object]]) -> dict[object, SourceSettings]:
    """Read {source: {target_column, target_column_id, models: [...]}}; unknown names are an error."""
    sources = {}
    for name, values in config.items():
        models = tuple(ModelSettings(**_known(ModelSettings, m)) for m in values["models"])
        rest = _known(SourceSettings, {k: v for k, v in values.items() if k != "models"})
        sources[name] = SourceSettings(models=models, **rest)
    return sources


@dataclass(frozen=True)
class Run:
    """One training run of the grid."""

    source: object
    settings: SourceSettings = field(repr=False)
    model: ModelSettings = field(repr=False)
    topics: int = 0


def grid(sources: Mapping[object, SourceSettings]) -> Iterator[Run]:
    """Every (source, model, number of topics)."""
    for name, source in sources.items():
        for model in source.models:
            for k in model.topic_counts():
                yield Run(name, source, model, k)


def group_grid(df: DataFrame, group: str, ks: range) -> DataFrame:
    """(group, lda_num_topics) for every group in the data and every number of topics."""
    counts = F.array(*[F.lit(k) for k in ks])
    return df.select(group).distinct().select(group, F.explode(counts).alias("lda_num_topics"))


def grid_table(spark: SparkSession, sources: Mapping[object, SourceSettings]) -> DataFrame:
    rows = [
        (str(r.source), r.settings.target_column, r.model.group_column, r.model.group_value, r.topics, r.model.lda_passes)
        for r in grid(sources)
    ]
    return spark.createDataFrame(
        rows,
        "source string, target_column string, group_column string, group_value string, lda_num_topics int, lda_passes int",
    )
