"""Derived listing attributes as column expressions (batch and streaming alike)."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.functions.numeric import at_least, flag


def car_age(year: Column, reference_year: int = V.REFERENCE_YEAR) -> Column:
    return at_least(F.lit(reference_year) - year, 1).cast("int")


def price_per_km(price: Column, mileage: Column) -> Column:
    return price / F.when(mileage == 0, F.lit(1)).otherwise(mileage)


def condition_score(condition: Column) -> Column:
    scores = F.create_map(*[F.lit(x) for kv in V.CONDITION_SCORES.items() for x in kv])
    return F.coalesce(
        F.try_element_at(scores, condition), F.lit(V.DEFAULT_CONDITION_SCORE)
    )


def has_amenity(amenities: Column, name: str) -> Column:
    return flag(F.array_contains(amenities, name))


def is_luxury(make: Column, luxury_makes: Iterable[str] = V.LUXURY_MAKES) -> Column:
    return flag(make.isin(list(luxury_makes)))


def segment(luxury_flag: Column) -> Column:
    return F.when(luxury_flag == 1, V.LUXURY_SEGMENT).otherwise(V.MASS_SEGMENT)
