"""The full pre-launch feature build (ENC6) and its column spec (SNK2)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.functions import lists as L
from prelaunch.functions import scalars as S
from prelaunch.operators import cohort as C
from prelaunch.operators.tags import MultiHot
from prelaunch.operators.text import Tfidf, description_text
from prelaunch.sources.tables import present


@dataclass
class FeatureSpec:
    """Which columns are numeric, categorical and vector features, the target and the time column."""
    numerical_features: list[str] = field(default_factory=list)
    categorical_features: list[str] = field(default_factory=list)
    vector_features: dict[str, list[str]] = field(default_factory=dict)   # vector column -> names of its slots; [] where a table has them
    target: str = "success"
    temporal_column: str = "release_year"
    # vector column -> (width, table of (slot, name)) of vocabularies too large for a list; written beside the spec, not in it
    name_tables: dict = field(default_factory=dict, compare=False, repr=False)

    def to_json(self) -> str:
        return json.dumps({f.name: getattr(self, f.name) for f in fields(self) if f.name != "name_tables"})

    @classmethod
    def from_json(cls, text: str) -> "FeatureSpec":
        return cls(**json.loads(text))

    def write(self, spark: SparkSession, path: str) -> None:
        """One-row JSON dataset (SNK2); tables of slot names go to ``path``-names/<column>."""
        spark.createDataFrame([(self.to_json(),)], "spec string").coalesce(1).write.mode("overwrite").text(path)
        for column, (width, names) in self.name_tables.items():
            names.select("slot", "name", F.lit(width).alias("width")).write.mode("overwrite").parquet(f"{path}-names/{column}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "FeatureSpec":
        spec = cls.from_json(spark.read.text(path).first()[0])
        for column in [c for c, names in spec.vector_features.items() if not names]:
            names = spark.read.parquet(f"{path}-names/{column}")
            spec.name_tables[column] = (names.first()["width"], names.select("slot", "name"))
        return spec


def build_features(df: DataFrame, fit_on: DataFrame | None = None, tfidf: Tfidf | None = None,
                   key: str | None = None, tag_output: str = "columns",
                   date_formats: tuple[str, ...] = S.DATE_FORMATS) -> tuple[DataFrame, FeatureSpec]:
    """Derive every pre-launch feature of the catalogue (ENC6).

    Columns that are absent are skipped, as the reference's guards do.
    ``fit_on`` is the frame the vocabularies (TF-IDF terms, tag lists) are
    learned from: the whole table by default (the reference's choice), or
    the training rows to keep the test period out of the fit.
    ``tag_output="vector"`` keeps tags as one sparse vector per list column,
    for vocabularies too wide for columns.
    """
    fit_on = df if fit_on is None else fit_on
    spec = FeatureSpec()
    out = C.with_release_parts(df, formats=date_formats) if "release_date" in df.columns else df
    num = spec.numerical_features
    for c in present(out, ["price", "dlc_count", "achievements", "required_age"]):
        out = out.withColumn(c, S.log1p_filled(c) if c in ("dlc_count", "achievements") else S.fill_zero(c))
        num.append(c)
    if "supported_languages" in out.columns:
        out = out.withColumn("language_count", L.list_length("supported_languages"))
        num.append("language_count")
    platforms = present(out, ["windows", "mac", "linux"])
    if platforms:
        out = out.withColumn("platform_count", S.row_sum_flags(platforms))
        num.append("platform_count")
    for src, stem in (("short_description", "desc"), ("detailed_features", "detailed_features")):
        if src in out.columns:
            out = out.withColumns({f"{stem}_length": S.char_length(src), f"{stem}_word_count": S.word_count(src)})
            num += [f"{stem}_length", f"{stem}_word_count"]
    if "short_description" in out.columns:
        model = tfidf or Tfidf()
        if key and key in fit_on.columns:
            fit_src, doc = fit_on, key
        else:  # any row id unique within the fit's single pass
            fit_src, doc = fit_on.withColumn("__row", F.monotonically_increasing_id()), "__row"
        model.fit(fit_src, description_text(fit_src), doc)
        out = model.transform_wide(out, description_text(out))
        num += model.columns
    cat = spec.categorical_features
    for col, prefix in (("genres", "genre_"), ("categories", "category_")):
        if col in out.columns:
            mh = MultiHot(col, prefix).fit(fit_on)
            if tag_output == "vector":
                out = mh.vector(out, f"{prefix}tags")
                names = mh.slot_names()
                spec.vector_features[f"{prefix}tags"] = names if isinstance(names, list) else []
                if not isinstance(names, list):
                    spec.name_tables[f"{prefix}tags"] = names
            else:
                out = mh.transform(out)
                cat += mh.columns
    for p in platforms:
        out = out.withColumn(p, S.flag01(p))
        cat.append(p)
    if "developers" in out.columns:
        out = C.with_developer_count(out)
        cat.append("dev_game_count")
    out = out.withColumn("is_free", S.is_free("price") if "price" in out.columns else F.lit(1))
    cat.append("is_free")
    if "release_quarter" in out.columns:
        out = out.withColumn("released_q4", S.q4_flag("release_quarter"))
        cat += ["release_month", "release_quarter", "released_q4"]
    return out, spec
