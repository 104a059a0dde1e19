"""Row layouts at the edges of the library, and the registry of series types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ZONE = "Europe/Madrid"
HISTORY_MONTHS = 23
RETRIES = 6


@dataclass(frozen=True)
class SeriesType:
    """One kind of series a meter delivers and how its history is cut into chunks."""

    prop: str
    freq: str
    months: int
    step_seconds: int | None
    endpoint: str
    params: tuple[str, ...]
    measurement_type: str | None = None

    @property
    def name(self) -> str:
        return f"{self.prop}_{self.freq}"


_CONSUMPTION_PARAMS = ("cups", "distributor_code", "start_date", "end_date",
                       "measurement_type", "point_type", "authorized_nif")
_POWER_PARAMS = ("cups", "distributor_code", "start_date", "end_date", "authorized_nif")

# The series types.
SERIES = (
    SeriesType("EnergyConsumptionGridElectricity", "PT1H", 1, 3600, "consumption",
               _CONSUMPTION_PARAMS, "0"),
    SeriesType("EnergyConsumptionGridElectricity", "PT15M", 1, 900, "consumption",
               _CONSUMPTION_PARAMS, "1"),
    SeriesType("Power", "P1M", 6, None, "max_power", _POWER_PARAMS),
)
# Only these are harmonized into points; power never is.
HARMONIZED = tuple(s for s in SERIES if s.step_seconds)

OWNER = T.StructType([T.StructField("startDate", T.StringType()),
                      T.StructField("endDate", T.StringType())])

MEASUREMENT = T.StructType([T.StructField("property", T.StringType()),
                            T.StructField("freq", T.StringType())])


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

# Field names of delivered and published records.
SUBSCRIPTION = _struct(
    seq=_L, source=_S, username=_S, authorized_nif=T.ArrayType(_S), self=T.BooleanType(),
    cups=T.ArrayType(_S), tables=T.ArrayType(_S), row_keys=T.ArrayType(T.ArrayType(_S)))

# The published supply record: supply fields, then the latest contract's fields. Contracted power is
# kept as given: a number or a list of numbers, as JSON text.
SUPPLY = _struct(
    address=_S, cups=_S, postalCode=_S, province=_S, provinceCode=_S, municipality=_S,
    municipioCode=_S, distributor=_S, validDateFrom=_S, validDateTo=_S,
    pointType=T.IntegerType(), distributorCode=_S, nif=_S, authorized_nif=_S,
    measurements=T.ArrayType(MEASUREMENT), startDate=_S, marketer=_S, tension=_S,
    accessFare=_S, contractedPowerkW=_S, timeDiscrimination=_S,
    modePowerControl=_S, endDate=_S, codeFare=_S, selfConsumptionTypeCode=_S,
    selfConsumptionTypeDesc=_S, section=_S, subsection=_S, partitionCoefficient=_S,
    cau=_S, installedCapacity=_D, dateOwner=T.ArrayType(OWNER), lastMarketerDate=_S,
    maxPowerInstall=_S)

LANDED_SUPPLY = _struct(
    seq=_L, username=_S, authorized_nif=_S, cups=_S, address=_S, postalCode=_S, province=_S,
    provinceCode=_S, municipality=_S, municipioCode=_S, distributor=_S, distributorCode=_S,
    validDateFrom=_S, validDateTo=_S, pointType=T.IntegerType())

CONTRACT = _struct(
    seq=_L, cups=_S, startDate=_S, endDate=_S, marketer=_S, tension=_S, accessFare=_S,
    contractedPowerkW=_S, timeDiscrimination=_S, modePowerControl=_S, codeFare=_S,
    selfConsumptionTypeCode=_S, selfConsumptionTypeDesc=_S, section=_S, subsection=_S,
    partitionCoefficient=_S, cau=_S, installedCapacity=_D, dateOwner=T.ArrayType(OWNER),
    lastMarketerDate=_S, maxPowerInstall=_S)

CONSUMPTION = _struct(cups=_S, datetime=_TS, consumptionKWh=_D, obtainMethod=_S)

READING = _struct(cups=_S, timestamp=_L, datetime=_S, consumptionKWh=_D, obtainMethod=_S,
                  freq=_S, prop=_S)

# What a reading of maximum power holds besides.
POWER_FIELDS = ("period", "period_ts", "max_power")

CHUNK_STATE = _struct(
    cups=_S, data_type=_S, chunk_key=_S, date_ini=T.TimestampNTZType(),
    date_end=T.TimestampNTZType(), values=_L, total=_L, retries=T.IntegerType(),
    date_min=_TS, date_max=_TS)
CHUNK_KEY = ["cups", "data_type", "chunk_key"]

# `data` and `row_keys` stay raw JSON: their shape depends on the kind of message, and a
# field of an unexpected type would otherwise mark the whole message as malformed.
ENVELOPE = _struct(
    data=_S, tables=_S, row_keys=_S,
    kwargs=_struct(collection_type=_S, property=_S, freq=_S, dblist=T.ArrayType(_S), run_id=_S,
                   partition=T.IntegerType(), partitions=T.IntegerType()),
    _bad=_S)

LEGACY_ROW = _struct(key=_S, consumptionKWh=T.FloatType(), obtainMethod=_S, datetime=_S)
GAZETTEER_TRIPLE = _struct(subject=_S, predicate=_S, object=_S)
