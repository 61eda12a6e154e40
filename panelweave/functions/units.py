"""Price index, unit factors and the model clock."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

# Implicit price deflator of gross domestic product, 2009 = 100
# base extended to 2021, one entry per year from 1929.
DEFLATOR_FIRST_YEAR = 1929
DEFLATOR_INDEX = (
    9.896, 9.535, 8.555, 7.553, 7.345, 7.749, 7.908, 8.001, 8.347,
    8.109, 8.033, 8.131, 8.68, 9.369, 9.795, 10.027, 10.288, 11.618,
    12.887, 13.605, 13.581, 13.745, 14.716, 14.972, 15.157, 15.298,
    15.559, 16.091, 16.625, 17.001, 17.237, 17.476, 17.669, 17.886,
    18.088, 18.366, 18.702, 19.227, 19.786, 20.627, 21.642, 22.784,
    23.941, 24.978, 26.337, 28.703, 31.361, 33.083, 35.135, 37.602,
    40.706, 44.377, 48.52, 51.53, 53.565, 55.466, 57.24, 58.395,
    59.885, 61.982, 64.392, 66.773, 68.996, 70.569, 72.248, 73.785,
    75.324, 76.699, 78.012, 78.859, 80.065, 81.887, 83.754, 85.039,
    86.735, 89.12, 91.988, 94.814, 97.337, 99.246, 100, 101.221,
    103.311, 105.214, 106.913, 108.828, 109.998, 111.445, 113.545,
    116.311, 118.339, 119.766, 124.743,
)

# Unit factors, named FROM_TO.
UNIT_FACTORS = {
    "BIL_MIL": 1000.0,
    "MIL_BIL": 1 / 1000,
    "BIL_THOUS": 1e6,
    "THOUS_BIL": 1e-6,
    "MIL_THOUS": 1000.0,
    "ONES_THOUS": 0.001,
    "TON_MEGATON": 1e-6,
    "T_KG": 1e3,
    "KG_T": 1e-3,
    "T_METRIC_SHORT": 1000 / 908,
    "HA_BM2": 1e-5,
    "HA_M2": 1e4,
    "THA_KGM2": 0.1,
    "G_TG": 1e-12,
    "GG_TG": 0.001,
    "TST_TG": 0.000907,
    "KG_TO_TG": 1e-9,
    "KT_MT": 0.001,
    "T_MT": 1e-6,
    "G_KG": 1e-3,
    "NH3_N": 14 / 17,
    "KBBL_BBL": 1000.0,
    "BBL_TONNE_RFO": 1 / 6.66,
    "TONNE_GJ_RFO": 40.87,
    "BBL_TONNE_DISTILLATE": 1 / 7.46,
    "TONNE_GJ_DISTILLATE": 42.91,
    "YEAR_HOURS": 24 * 365.25,
    "DAYS_YEAR": 1 / 365.25,
    "DAY_HOURS": 24.0,
    "MWH_GJ": 3.6,
    "MWH_EJ": 3.6e-9,
    "GWH_EJ": 3.6e-6,
    "TWH_EJ": 3.6e-3,
    "KWH_GJ": 3.6e-3,
    "GJ_EJ": 1e-9,
    "MJ_EJ": 1e-12,
    "EJ_GJ": 1e9,
    "MBLD_EJYR": 6.119 * 365.25 * 1e-3,
    "KBTU_EJ": 1.0551e-12,
    "TBTU_EJ": 0.0010551,
    "MJ_BTU": 947.777,
    "BTU_KJ": 1.0551,
    "MMBTU_KGH2": 0.113939965425114,
    "GJ_KGH2": 0.12021,
    "MILE_KM": 1.60934,
    "NMILE_KM": 1.852,
    "MCAL_PCAL": 1e-9,
    "M3_BM3": 1e-9,
    "MILLION_M3_KM3": 1e-3,
    "M2_ACR": 0.0002471058,
    "BM2_M2": 1e9,
    "MILFT2_M2": 92900.0,
    "FT2_M2": 0.0929,
    "GAL_M3": 0.00378541,
    "PERS_MILPERS": 1e6,
    "RESID_BTU_PER_BBL": 6.29,
    "RESID_BBLS_PER_TONNE": 6.66,
}


def deflator(year: int, base_year: int) -> float:
    """Factor from ``base_year`` money to ``year`` money."""
    position = [y - DEFLATOR_FIRST_YEAR for y in (year, base_year)]
    if not all(0 <= p < len(DEFLATOR_INDEX) for p in position):
        raise ValueError(f"no price index for {year} or {base_year}")
    return DEFLATOR_INDEX[position[0]] / DEFLATOR_INDEX[position[1]]


def deflator_from(base_year: Column, year: int) -> Column:
    """Factor from a row's own year to ``year`` money; an unknown year fails the job."""
    index = F.array(*[F.lit(float(v)) for v in DEFLATOR_INDEX])
    target = DEFLATOR_INDEX[year - DEFLATOR_FIRST_YEAR]
    known = base_year.between(DEFLATOR_FIRST_YEAR, DEFLATOR_FIRST_YEAR + len(DEFLATOR_INDEX) - 1)
    return F.when(
        known, F.lit(float(target)) / F.element_at(index, base_year - F.lit(DEFLATOR_FIRST_YEAR - 1))
    ).otherwise(F.raise_error(F.lit("year outside the price index")).cast("double"))


@dataclass(frozen=True)
class ModelTime:
    """Model clock: calibrated years, projected years and the annual history."""

    base_years: tuple[int, ...] = (1975, 1990, 2005, 2010, 2015)
    future_years: tuple[int, ...] = tuple(range(2020, 2101, 5))
    historical_years: tuple[int, ...] = tuple(range(1971, 2016))
    first_timestep: int = 15

    @property
    def years(self) -> tuple[int, ...]:
        return self.base_years + self.future_years

    @property
    def tokens(self) -> dict[str, int]:
        """Year words usable in place of a number."""
        last_history = max(self.historical_years)
        return {
            "start-year": min(self.base_years),
            "final-calibration-year": max(self.base_years),
            "final-historical-year": last_history,
            "initial-future-year": min(self.future_years),
            "initial-nonhistorical-year": min(y for y in self.years if y > last_history),
            "end-year": max(self.future_years),
        }

    def next_year(self, year: Column) -> Column:
        """The following model year; the last maps to itself, others fail the job."""
        steps = list(zip(self.years, self.years[1:] + self.years[-1:]))
        unknown = F.raise_error(F.lit("not a model year")).cast("int")
        return reduce(
            lambda rest, step: F.when(year == step[0], F.lit(step[1])).otherwise(rest),
            reversed(steps),
            F.when(year.isNotNull(), unknown),
        )

    def year_number(self, c: Column) -> Column:
        """Number for a year given as digits or as one of the words; other text gives null."""
        out = c.try_cast("int")
        for word, year in self.tokens.items():
            out = F.when(c == F.lit(word), F.lit(year)).otherwise(out)
        return out
