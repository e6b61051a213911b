"""Array and matrix columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def scale(values: Column, divisor: float) -> Column:
    """Every value as 32-bit float, divided by `divisor`."""
    return F.transform(values.cast("array<float>"), lambda v: v / F.lit(divisor)).cast("array<float>")


def flatten_matrix(rows: Column) -> Column:
    """A matrix as one array, row after row."""
    return F.flatten(rows)


def reshape(values: Column, rows: int, columns: int) -> Column:
    """An array of `rows * columns` values as a row-major matrix; NULL if the length differs."""
    matrix = F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)),
        lambda i: F.slice(values, i * columns + 1, F.lit(columns)),
    )
    return F.when(F.size(values) == rows * columns, matrix)


def one_hot(label: Column, classes: int) -> Column:
    """A 0/1 array of width `classes` with 1 at the label's place; NULL for NULL.

    A label that is no whole number in 0 .. classes-1 is an error.
    """
    number = label.cast("double")
    fits = (number >= 0) & (number < classes) & (F.floor(number) == number)
    places = F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)),
        lambda i: F.when(i == label.cast("int"), 1.0).otherwise(0.0),
    )
    wrong = F.concat(F.lit(f"labels must be in 0..{classes - 1}, found "), label.cast("string"))
    return F.when(label.isNotNull(), F.when(fits, places).otherwise(F.raise_error(wrong)))


def class_index(one_hot_label: Column) -> Column:
    """The place of the largest value, as a double: the inverse of `one_hot`. NULL if no value is above 0."""
    largest = F.array_max(one_hot_label)
    place = (F.array_position(one_hot_label, largest) - 1).cast("double")
    return F.when((largest > 0) & ~F.isnan(largest), place)


def whole_number(label: Column) -> Column:
    """A class index as an int; a value with a fraction is an error."""
    number = label.cast("double")
    wrong = F.concat(F.lit("labels must be whole numbers, found "), label.cast("string"))
    whole = F.when(F.floor(number) == number, number.cast("int")).otherwise(F.raise_error(wrong))
    return F.when(label.isNotNull(), whole)
