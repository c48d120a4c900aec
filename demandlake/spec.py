"""What a dataset looks like: domains, attribute types, schemas, frequencies.

Nothing here touches data. These objects parameterise column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TARGET_TIME_SERIES = "TARGET_TIME_SERIES"
RELATED_TIME_SERIES = "RELATED_TIME_SERIES"
ITEM_METADATA = "ITEM_METADATA"

# The identifier and the target field of each domain.
DOMAINS = {
    "RETAIL": ("item_id", "demand"),
    "CUSTOM": ("item_id", "target_value"),
    "INVENTORY_PLANNING": ("item_id", "demand"),
    "EC2_CAPACITY": ("instance_type", "number_of_instances"),
    "WORK_FORCE": ("workforce_type", "workforce_demand"),
    "WEB_TRAFFIC": ("item_id", "value"),
    "METRICS": ("metric_name", "metric_value"),
}

# Declared attribute types and the column types they are stored as.
ATTRIBUTE_TYPES = {
    "string": T.StringType(),
    "geolocation": T.StringType(),
    "integer": T.IntegerType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

# Supported frequencies, coarse to fine, as (months, seconds) per step.
# Calendar steps have months, the rest a fixed number of seconds.
FREQUENCIES = {
    "Y": (12, 0),
    "M": (1, 0),
    "W": (0, 7 * 86400),
    "D": (0, 86400),
    "H": (0, 3600),
    "30min": (0, 1800),
    "15min": (0, 900),
    "10min": (0, 600),
    "5min": (0, 300),
    "1min": (0, 60),
}


def domain_fields(domain: str) -> tuple[str, str]:
    """(identifier, target) of a domain."""
    try:
        return DOMAINS[domain]
    except KeyError:
        raise ValueError(f"unknown domain {domain!r}, expected one of {', '.join(DOMAINS)}") from None


def frequency_step(frequency: str) -> tuple[int, int]:
    """(months, seconds) of one step."""
    try:
        return FREQUENCIES[frequency]
    except KeyError:
        raise ValueError(
            f"unknown frequency {frequency!r}, expected one of {', '.join(FREQUENCIES)}"
        ) from None


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str

    @property
    def data_type(self) -> T.DataType:
        try:
            return ATTRIBUTE_TYPES[self.kind]
        except KeyError:
            raise ValueError(f"attribute {self.name!r} has unknown type {self.kind!r}") from None


@dataclass(frozen=True)
class DatasetSpec:
    """Ordered attributes of one dataset in one domain."""

    domain: str
    attributes: tuple[Attribute, ...]

    @classmethod
    def of(cls, domain: str, **kinds: str) -> "DatasetSpec":
        """``DatasetSpec.of("CUSTOM", item_id="string", timestamp="timestamp")``"""
        return cls(domain, tuple(Attribute(name, kind) for name, kind in kinds.items()))

    @property
    def identifier(self) -> str:
        return domain_fields(self.domain)[0]

    @property
    def target(self) -> str:
        return domain_fields(self.domain)[1]

    @property
    def fields(self) -> list[str]:
        return [a.name for a in self.attributes]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(a.name, a.data_type, True) for a in self.attributes])

    @property
    def text_struct(self) -> T.StructType:
        """The same columns before casting: all strings, named by position."""
        return T.StructType(
            [T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(self.attributes))]
        )

    @property
    def dimensions(self) -> list[str]:
        """Fields of a target series other than identifier, timestamp and target."""
        return [f for f in self.fields if f not in (self.identifier, self.target, "timestamp")]
