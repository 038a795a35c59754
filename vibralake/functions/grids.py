"""Frequency grids and interpolation in closed form, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vibralake.schemas import GRID_HIGH, GRID_LOW, GRID_POINTS, SAMPLING_RATE


def bin_frequency(k: Column, n: Column, rate: float = SAMPLING_RATE) -> Column:
    """Frequency of bin k of the transform of n samples."""
    return k * F.lit(rate) / n


def grid_frequency(k: Column, low: float = GRID_LOW, high: float = GRID_HIGH, points: int = GRID_POINTS) -> Column:
    """Frequency of point k of an evenly spaced grid with both ends."""
    return F.lit(low) + k * (F.lit(high - low) / F.lit(points - 1))


def interpolated(amplitude: Column, n: Column, frequency: Column, rate: float = SAMPLING_RATE) -> Column:
    """Linear interpolation of a spectrum of n samples at a frequency, held at both ends; no join is needed as bins are evenly spaced."""
    position = F.greatest(frequency * n / F.lit(rate), F.lit(0.0))
    below = F.floor(position).cast("int")
    last = F.size(amplitude) - 1
    left, right = F.get(amplitude, below), F.get(amplitude, below + 1)
    return F.when(below >= last, F.get(amplitude, last)).otherwise(left + (right - left) * (position - below))


def on_grid(amplitude: Column, n: Column, points: int = GRID_POINTS) -> Column:
    """A spectrum at all points of the common grid."""
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: interpolated(amplitude, n, grid_frequency(k)))
