"""Settings as tables: typed, layered over defaults, with errors as rows.

Layers are rows (profile, layer, name, value), values as text. For each profile and declared name the highest layer
whose value is of the right kind and range counts, then the default. What can't be used is an error row and changes
nothing. Resolved settings are one row a profile, joined to data by profile where thresholds are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.attempts import attempt_each

KINDS = {"double": "double", "long": "bigint", "boolean": "boolean", "string": "string"}
LAYERS = "profile string, layer int, name string, value string"
# profiles that are broadcast, some 100 bytes each
FEW = 100_000
# error codes
UNKNOWN, KIND, RANGE = "unknown_name", "wrong_kind", "out_of_range"


@dataclass(frozen=True)
class Setting:
    """A declared name; least and most bound numbers, both included."""

    name: str
    kind: str
    default: float | int | bool | str
    least: float | None = None
    most: float | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")

    @property
    def column(self) -> str:
        return self.name.replace(".", "__")


# fixed values: the names and defaults of acceptance
ACCEPT = [
    Setting("quality_thresholds.min_duration", "double", 2.0, 0),
    Setting("quality_thresholds.max_duration", "double", 15.0, 0),
    Setting("quality_thresholds.min_snr_db", "double", 12.0),
    Setting("quality_thresholds.min_speech_ratio", "double", 0.5, 0, 1),
    Setting("quality_thresholds.min_word_count", "long", 3, 0),
    Setting("quality_thresholds.min_quality_score", "double", 0.5, 0, 1),
]
# those of the check of whole files
CHECK = [
    Setting("preprocessing.quality_check.min_duration", "double", 1.0, 0),
    Setting("preprocessing.quality_check.max_duration", "double", 30.0, 0),
    Setting("preprocessing.quality_check.snr_threshold", "double", 15.0),
]


def _text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _declared(spark: SparkSession, settings: list[Setting]) -> DataFrame:
    bound = lambda x: None if x is None else float(x)
    rows = [(s.name, s.kind, _text(s.default), bound(s.least), bound(s.most)) for s in settings]
    return F.broadcast(spark.createDataFrame(rows, "name string, kind string, default string, least double, most double"))


def _number(kind: str) -> Column:
    return F.trim("value").try_cast(kind)


def judged(layers: DataFrame, settings: list[Setting]) -> DataFrame:
    """layers with `error`: null for values that may be used. A null value is no value and no error."""
    given = layers.where("value is not null").join(_declared(layers.sparkSession, settings), "name", "left")
    # a whole number is written without a point; truth as true or false
    fits = F.when(F.col("kind") == "double", _number("double").isNotNull() & ~F.isnan(F.coalesce(_number("double"), F.lit(0.0))))
    fits = fits.when(F.col("kind") == "long", F.trim("value").rlike(r"^[+-]?[0-9]+$") & _number("bigint").isNotNull())
    fits = fits.when(F.col("kind") == "boolean", F.lower(F.trim("value")).isin("true", "false")).otherwise(True)
    outside = F.col("kind").isin("double", "long") & ((_number("double") < F.col("least")) | (_number("double") > F.col("most")))
    error = F.when(F.col("kind").isNull(), UNKNOWN).when(~fits, KIND).when(F.coalesce(outside, F.lit(False)), RANGE)
    return given.select("profile", "layer", "name", "value", error.alias("error"))


def setting_errors(layers: DataFrame, settings: list[Setting]) -> DataFrame:
    """(profile, layer, name, value, error) of every value that isn't used for what it is."""
    return judged(layers, settings).where("error is not null")


def resolved(layers: DataFrame, settings: list[Setting]) -> DataFrame:
    """One typed row a profile of layers: profile, then a column for each setting (dots as two underscores).

    Of equal layers the lesser value counts.
    """
    usable = judged(layers, settings).where("error is null")
    picked = usable.groupBy("profile", "name").agg(F.min(F.struct((-F.col("layer")).alias("minus"), F.trim("value").alias("value")))["value"].alias("value"))
    wide = picked.groupBy("profile").agg(*[F.max(F.when(F.col("name") == s.name, F.col("value"))).alias(s.column) for s in settings])
    # a row without a usable value still makes its profile known
    every = layers.select("profile").distinct().join(wide, "profile", "left")
    typed = [F.coalesce(F.col(s.column).cast(KINDS[s.kind]), F.lit(s.default).cast(KINDS[s.kind])).alias(s.column) for s in settings]
    return every.select("profile", *typed)


def with_settings(rows: DataFrame, settings_of: DataFrame, settings: list[Setting], profile: str = "profile") -> DataFrame:
    """rows with the settings of their profile; a profile without a row has the defaults.

    The settings table has a row a profile. One of up to FEW is broadcast: few profiles mean many rows each, which would meet in
    one task. Spark can't see that size before, as the table comes out of joins.
    """
    named = settings_of.withColumnRenamed("profile", "__profile")
    if settings_of.limit(FEW + 1).count() <= FEW:
        named = F.broadcast(named)
    joined = rows.join(named, F.col(profile) == F.col("__profile"), "left").drop("__profile")
    return joined.withColumns({s.column: F.coalesce(s.column, F.lit(s.default).cast(KINDS[s.kind])) for s in settings})


def flattened(tree, at: str = "") -> dict[str, str]:
    """Nested mappings as dotted names; lists and nulls are left out, as no setting has such a value."""
    out: dict[str, str] = {}
    for key, value in (tree or {}).items():
        name = f"{at}{key}"
        if isinstance(value, dict):
            out |= flattened(value, f"{name}.")
        elif value is not None and not isinstance(value, list):
            out[name] = _text(value)
    return out


def _parsed(row: dict) -> dict:
    try:
        from yaml import safe_load
    except ImportError:
        # JSON is read without the library
        from json import loads as safe_load

    tree = safe_load(row["text"]) if row["text"].strip() else None
    if tree is not None and not isinstance(tree, dict):
        raise ValueError("no mapping at the top")
    return {"given": list(flattened(tree).items())}


def read_layers(spark: SparkSession, files: list[tuple[str, int, str]]) -> tuple[DataFrame, DataFrame]:
    """(layers, errors) of configuration files (profile, layer, path), YAML or JSON.

    A file that is missing, empty or broken gives no values, so its profile has what lies below; a missing or broken one is an error row
    (profile, layer, path, error).
    """
    rows = spark.createDataFrame(files, "profile string, layer int, path string")
    paths = [p for _, _, p in files]
    texts = None
    for path in dict.fromkeys(paths):
        try:
            one = spark.read.text(path, wholetext=True).select(F.lit(path).alias("path"), F.col("value").alias("text"))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            one = spark.createDataFrame([(path, None)], "path string, text string")
        texts = one if texts is None else texts.unionByName(one)
    if texts is None:
        return spark.createDataFrame([], LAYERS), spark.createDataFrame([], "profile string, layer int, path string, error string")
    found = rows.join(texts, "path", "left").withColumn("missing", F.col("path").isin([r["path"] for r in texts.where("text is null").select("path").collect()] or [""]))
    tried = attempt_each(found.withColumn("text", F.coalesce("text", F.lit(""))), _parsed, "given map<string,string>")
    layers = tried.where("given is not null").select("profile", "layer", F.explode_outer("given").alias("name", "value"))
    errors = tried.withColumn("error", F.when(F.col("missing"), "missing").otherwise(F.col("error"))).where("error is not null")
    return layers.select("profile", "layer", "name", "value"), errors.select("profile", "layer", "path", "error")
