"""Slice geometry on columns: parsing, validation, vectors, affine matrix, pixel arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from studyloom.functions.staging import computed_once
from studyloom.functions.text import WHITESPACE

ONE_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
# The conversion to double ignores the white space around a number itself.
NUMBER = f"^[{WHITESPACE}]*{ONE_NUMBER}[{WHITESPACE}]*$"


def parse_number(c: Column) -> Column:
    """Number in a text field; null for null, blank, the missing-value word or bad text."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def parse_vector(c: Column, size: int) -> Column:
    """First `size` numbers of a `[a, b, ...]` text; null if one entry is bad or too few."""
    # the usual form is cut as it is; a text without a comma is no vector
    usual = c.rlike(rf"^\[{ONE_NUMBER}(?:, ?{ONE_NUMBER}){{{size - 1}}}\]\z")
    inner = F.substr(c, F.lit(2), F.length(c) - 2)
    entries = F.btrim(F.replace(F.btrim(c, F.lit("[]")), F.lit(" "), F.lit("")), F.lit(","))
    # the pattern counts the entries, so that they are only cut and converted where they are returned
    enough = entries.rlike(f"^{ONE_NUMBER}(?:,+{ONE_NUMBER}){{{size - 1},}}$")
    listed = F.split(F.regexp_replace(entries, ",+", ","), ",")
    return F.when(usual, F.split(inner, ",").try_cast("array<double>")).when(
        c.contains(","), F.when(enough, F.slice(listed.try_cast("array<double>"), 1, size)))


def parse_orientation(c: Column) -> Column:
    return parse_vector(c, 6)


def parse_position(c: Column) -> Column:
    return parse_vector(c, 3)


def spacing_parts(c: Column) -> Column:
    """Texts of the row and column spacing; the first separator present splits, one value is square."""
    return (
        F.when(c.contains("\\\\"), F.split(c, r"\\\\"))
        .when(c.contains("\\"), F.split(c, r"\\"))
        .when(c.contains("/"), F.split(c, "/"))
        .when(c.contains(","), F.split(c, ","))
        .otherwise(F.array(c, c))
    )


def parse_spacing(c: Column) -> Column:
    """Row and column spacing, null if one of them is unreadable."""
    parts = spacing_parts(c)
    return both_spacings(parse_number(F.get(parts, 0)), parse_number(F.get(parts, 1)))


def both_spacings(row: Column, column: Column) -> Column:
    return F.when(row.isNotNull() & column.isNotNull(), F.array(row, column))


def repair_thickness(c: Column) -> Column:
    """A thickness above 100 was written in micrometres."""
    return F.when(c > 100, c / 1000).otherwise(c)


def decimals(c: Column, places: int = 3) -> Column:
    return F.when(c.isNotNull(), F.format_string(f"%.{places}f", F.bround(c, places)))


# A vector of three: an array column, or its three components.
Vector = Column | list[Column]


def at(v: Vector, i: int) -> Column:
    return v[i] if isinstance(v, list) else F.get(v, i)


def directions(orientation: Column) -> tuple[list[Column], list[Column]]:
    """Components of the row and the column vector of an orientation."""
    numbers = [F.get(orientation, i) for i in range(6)]
    return numbers[:3], numbers[3:]


def dot(a: Vector, b: Vector) -> Column:
    """Scalar product of two vectors of three."""
    return at(a, 0) * at(b, 0) + at(a, 1) * at(b, 1) + at(a, 2) * at(b, 2)


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vector, b: Vector) -> Column:
    return F.array(
        at(a, 1) * at(b, 2) - at(a, 2) * at(b, 1),
        at(a, 2) * at(b, 0) - at(a, 0) * at(b, 2),
        at(a, 0) * at(b, 1) - at(a, 1) * at(b, 0),
    )


def slice_direction(orientation: Column) -> Column:
    """Normal of the slice plane, null without orientation."""
    return F.when(orientation.isNotNull(), cross(*directions(orientation)))


def slice_position(position: Column, direction: Column) -> Column:
    """Position along the unit slice direction; the z coordinate without orientation.

    A direction of length zero gives no usable position.
    """
    length = norm(direction)
    along = F.when(length > 0, dot(position, direction) / length)
    return F.when(direction.isNull(), F.get(position, 2)).otherwise(along)


def messages(*found: Column) -> Column:
    """Array of the messages that apply, in order."""
    return F.filter(F.array(*found), lambda m: m.isNotNull())


def with_geometry(df, prefix: str = "", location: str | None = None, joined: bool = False):
    """Add parsed geometry and its validation.

    Columns: orientation, position, spacing, thickness, row_spacing, col_spacing
    (1.0 where unreadable), direction, geometry_warnings, geometry_errors (arrays, or texts
    separated by `; ` if `joined`), geometry_valid, and slice_location_mm if `location` names
    that field.
    """
    listed = (lambda *found: F.concat_ws("; ", *found)) if joined else messages
    # each text is parsed once, in steps small enough to be compiled
    parts = computed_once(
        df, orientation=parse_orientation(F.col(f"{prefix}image_orientation_patient")),
        position=parse_position(F.col(f"{prefix}image_position_patient")),
        _parts=spacing_parts(F.col(f"{prefix}pixel_spacing")))
    parsed = computed_once(
        parts, _row=parse_number(F.get("_parts", 0)), _column=parse_number(F.get("_parts", 1)),
        raw_thickness=parse_number(F.col(f"{prefix}slice_thickness"))).withColumn(
        "spacing", both_spacings(F.col("_row"), F.col("_column"))).drop("_parts", "_row", "_column")
    if location is not None:
        parsed = parsed.withColumn("slice_location_mm", parse_number(F.col(location)))
    row, column = directions(F.col("orientation"))
    row_mm, column_mm = F.get("spacing", 0), F.get("spacing", 1)
    thickness = repair_thickness(F.col("raw_thickness"))
    # Tolerances and message texts of the geometry check.
    not_unit = (F.abs(norm(row) - 1.0) > 0.1) | (F.abs(norm(column) - 1.0) > 0.1)
    skewed = F.abs(dot(row, column)) > 0.1
    odd_spacing = ~row_mm.between(0.1, 10.0) | ~column_mm.between(0.1, 10.0)
    return parsed.withColumns({
        "thickness": thickness,
        "row_spacing": F.coalesce(row_mm, F.lit(1.0)),
        "col_spacing": F.coalesce(column_mm, F.lit(1.0)),
        "direction": slice_direction(F.col("orientation")),
        "geometry_warnings": listed(
            F.when(not_unit, "Direction cosines are not unit vectors"),
            F.when(skewed, "Row and column vectors are not orthogonal"),
            F.when(odd_spacing, F.concat(F.lit("Unusual pixel spacing: "),
                                         row_mm.cast("string"), F.lit("x"),
                                         column_mm.cast("string"), F.lit(" mm"))),
            F.when(F.col("spacing").isNull(), "Failed to parse PixelSpacing"),
            F.when(F.col("raw_thickness") > 100, F.concat(
                F.lit("Converted slice thickness: "), F.col("raw_thickness").cast("string"),
                F.lit(" -> "), decimals(thickness), F.lit("mm (divided by 1000)"))),
            F.when(~thickness.between(0.1, 50.0), F.concat(
                F.lit("Unusual slice thickness: "), decimals(thickness), F.lit("mm"))),
        ),
        "geometry_errors": listed(
            F.when(F.col("orientation").isNull(), "Failed to parse ImageOrientationPatient"),
            F.when(F.col("position").isNull(), "Failed to parse ImagePositionPatient"),
        ),
        "geometry_valid": F.col("orientation").isNotNull() & F.col("position").isNotNull(),
    })


def affine_matrix(orientation: Column, position: Column, row_spacing: Column,
                  col_spacing: Column, slice_spacing: Column) -> Column:
    """4x4 matrix from voxel to patient space with x and y mirrored; identity if incomplete."""
    row, column = directions(orientation)
    normal = cross(row, column)
    origin = [-F.get(position, 0), -F.get(position, 1), F.get(position, 2)]
    lines = [
        F.array(-row[i] * row_spacing, -column[i] * col_spacing,
                F.get(normal, i) * slice_spacing, origin[i])
        for i in range(3)
    ]
    lines.append(F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]))
    identity = F.array(*[F.array(*[F.lit(1.0 if i == j else 0.0) for j in range(4)])
                         for i in range(4)])
    complete = orientation.isNotNull() & position.isNotNull() & slice_spacing.isNotNull()
    return F.when(complete, F.array(*lines)).otherwise(identity)


def rescale(pixels: Column, slope: Column, intercept: Column) -> Column:
    return F.transform(pixels, lambda p: p * slope + intercept)


def flip_rows(image: Column) -> Column:
    """Mirror both in-plane axes of an image stored as an array of rows."""
    return F.transform(F.reverse(image), lambda line: F.reverse(line))
