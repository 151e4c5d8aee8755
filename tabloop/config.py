"""Problem descriptor: which columns are features, which is the target."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class ProblemConfig:
    """Feature roles and split settings of one problem of one phase."""

    phase_id: str
    prob_id: str
    target: str = "label"
    categorical: tuple[str, ...] = ()
    numerical: tuple[str, ...] = ()
    ml_type: str = "classification"
    features: tuple[str, ...] = ()
    test_size: float = 0.1
    seed: int = 1242
    types: dict[str, str] = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if not self.features:
            object.__setattr__(self, "features", tuple(self.categorical) + tuple(self.numerical))
        unknown = (set(self.categorical) | set(self.numerical)) - set(self.features)
        if unknown:
            raise ValueError(f"columns with a role but not listed as features: {sorted(unknown)}")

    @property
    def multiclass(self) -> bool:
        return self.prob_id == "prob-2" and self.phase_id != "phase-1"

    def feature_type(self, name: str) -> str:
        return self.types.get(name, "string" if name in self.categorical else "double")

    def schema(self, with_target: bool = True) -> T.StructType:
        """Declared schema of the labelled table; nothing is inferred."""
        fields = [T.StructField("row_id", T.LongType(), False)]
        fields += [T.StructField(c, _parse(self.feature_type(c))) for c in self.features]
        if with_target:
            fields.append(T.StructField(self.target, _parse(self.types.get(self.target, "int"))))
        return T.StructType(fields)

    @classmethod
    def load(cls, spark: SparkSession, path: str, phase_id: str, prob_id: str, **overrides) -> "ProblemConfig":
        """Read the feature-role JSON (`target_column`, `category_columns`, `numeric_columns`, `ml_type`)."""
        text = spark.read.text(path, wholetext=True).first()
        if text is None:
            raise ValueError(f"empty configuration: {path}")
        raw = json.loads(text.value)
        return cls(
            phase_id=phase_id,
            prob_id=prob_id,
            target=raw["target_column"],
            categorical=tuple(raw["category_columns"]),
            numerical=tuple(raw["numeric_columns"]),
            ml_type=raw["ml_type"],
            **overrides,
        )


def _parse(name: str) -> T.DataType:
    return T._parse_datatype_string(name) if name not in _SIMPLE else _SIMPLE[name]


_SIMPLE = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}
