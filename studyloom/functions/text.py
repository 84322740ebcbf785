"""Text functions on columns: names, paths, sizes, ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"
WHITESPACE = " \t\n\r\x0b\x0c"
KEY_JOIN = "_._"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank(c: Column) -> Column:
    """True for null, empty or whitespace-only text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def known(c: Column) -> Column:
    """True for text that is neither null, empty nor the missing-value word."""
    return F.coalesce((c != "") & (c != UNKNOWN), F.lit(False))


def valid_id(c: Column) -> Column:
    """The id where it may identify a patient (known and longer than three characters)."""
    return F.when(known(c) & (F.length(c) > 3), c)


def name_tokens(name: Column) -> Column:
    """Sorted distinct upper-case words of a name; empty for a missing one."""
    words = F.array_remove(F.split(F.upper(F.translate(name, "^", " ")), r"\s+"), "")
    return F.when(known(name), F.sort_array(F.array_distinct(words))) \
        .otherwise(F.array().cast("array<string>"))


def token_jaccard(left: Column, right: Column) -> Column:
    """Shared over all tokens of two token arrays; 0 if either is empty."""
    return F.when(
        (F.size(left) > 0) & (F.size(right) > 0),
        F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right)),
    ).otherwise(F.lit(0.0))


def name_jaccard(left: Column, right: Column) -> Column:
    return token_jaccard(name_tokens(left), name_tokens(right))


def study_key(date: Column, patient: Column, station: Column, institution: Column) -> Column:
    center = F.coalesce(F.nullif(station, F.lit("")), F.nullif(institution, F.lit("")),
                        F.lit(UNKNOWN))
    return F.concat_ws(KEY_JOIN, F.coalesce(date, F.lit(UNKNOWN)),
                       F.coalesce(patient, F.lit(UNKNOWN)), center, F.lit("Study.jsonl"))


def safe_file_name(name: Column, longest: int = 255) -> Column:
    """Replace characters a file system rejects, cap the length keeping the extension."""
    clean = F.regexp_replace(name, r'[\\/:*?"<>|\x00-\x1f]', "_")
    extension = F.substring_index(clean, ".", -1)
    stem = F.substr(clean, F.lit(1), F.length(clean) - F.length(extension) - 1)
    room = F.lit(longest - 1) - F.length(extension)
    kept = F.when(room >= 0, room).otherwise(F.greatest(F.length(stem) + room, F.lit(0)))
    capped = F.when(
        (F.length(clean) > longest) & clean.contains("."),
        F.concat(F.substr(stem, F.lit(1), kept), F.lit("."), extension),
    ).otherwise(F.substring(clean, 1, longest))
    return F.coalesce(F.nullif(F.btrim(capped, F.lit(" .")), F.lit("")), F.lit("unnamed_file"))


def parent_folder(path: Column) -> Column:
    """Directory part of a path with either separator; null for an empty path."""
    folder = F.regexp_extract(path, r"^(.*[/\\])[^/\\]*$", 1)
    trimmed = F.rtrim(folder, F.lit("/\\"))
    return F.when(path != "", F.when(trimmed == "", folder).otherwise(trimmed))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def file_extension(path: Column) -> Column:
    """Lower-case text after the last dot of the file name, '' without one."""
    return F.regexp_extract(F.lower(base_name(path)), r"\.([^.]*)$", 1)


def folder_key(relative: Column) -> Column:
    """Relative folder path as a flat key; the root folder is '.'."""
    return F.when(relative == "", F.lit(".")).otherwise(F.replace(relative, F.lit("/"),
                                                                  F.lit(KEY_JOIN)))


def normal_path(path: Column) -> Column:
    """Path without drive, with forward slashes, no outer slashes, lower case; '' if null."""
    driveless = F.regexp_replace(strip(path), "^[A-Za-z]:", "")
    slashed = F.translate(driveless, "\\", "/")
    return F.coalesce(F.lower(F.btrim(slashed, F.lit("/"))), F.lit(""))


def path_ancestors(normal: Column) -> Column:
    """Every leading part of a normalised path, itself included; empty for ''."""
    parts = F.split(normal, "/")
    return F.when(normal != "", F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )).otherwise(F.array().cast("array<string>"))


def path_is_under(new: Column, old: Column) -> Column:
    """New path equals the old one or lies below it, after normalisation."""
    n, o = normal_path(new), normal_path(old)
    return (n != "") & (o != "") & ((n == o) | n.startswith(F.concat(o, F.lit("/"))))


def id_without_suffix(value: Column) -> Column:
    """Id cut at its last underscore."""
    return F.coalesce(F.regexp_replace(strip(value), "_[^_]*$", ""), F.lit(""))


def date_digits(value: Column) -> Column:
    """Date text without separators; null for null or blank, which never agree."""
    return F.nullif(F.regexp_replace(value, r"[-/\s]", ""), F.lit(""))


def swap_drive(path: Column, drive: str) -> Column:
    return F.when(F.substring(path, 2, 1) == ":",
                  F.concat(F.lit(drive + ":"), F.substr(path, F.lit(3)))).otherwise(path)


def package_file_name(position: Column, path: Column) -> Column:
    return F.format_string("ROW_%04d_%s", position, base_name(path))


def unsafe_path(path: Column) -> Column:
    return path.startswith("/") | path.contains("..")


def flat_archive_name(path: Column) -> Column:
    """Parent folders and stem of an archive path as one name of at most 100 characters."""
    bare = F.btrim(F.regexp_replace(F.translate(path, "\\", "/"), "^[A-Za-z]:", ""), F.lit("/"))
    flat = F.replace(F.regexp_replace(bare, r"(?<=[^/])\.[^./]*$", ""), F.lit("/"),
                     F.lit(KEY_JOIN))
    return F.when(F.length(flat) > 100, F.concat(F.substring(flat, 1, 97), F.lit("..."))) \
        .otherwise(flat)


def project_name(location: Column, ordinal: Column) -> Column:
    """Last two folders of a location as a name; a numbered one if nothing is left."""
    bare = F.btrim(F.translate(location, "\\", "/"), F.lit("/"))
    tail = F.substring_index(bare, "/", -2)
    protected = F.transform(F.split(F.replace(tail, F.lit("/"), F.lit(KEY_JOIN)), r"_\._"),
                            lambda p: F.regexp_replace(p, r"(?U)[^\w-]", "_"))
    return F.coalesce(F.nullif(F.array_join(protected, KEY_JOIN), F.lit("")),
                      F.format_string("location_%03d", ordinal))


def custom_project_name(base: str, ordinal: Column) -> Column:
    return F.format_string("%s_%03d", F.lit(base), ordinal)


def study_name(file_name: Column) -> Column:
    """Study name behind a stored study file."""
    stem = F.regexp_replace(base_name(file_name), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(stem, "^S3_processForStore_", "")


def human_size(size: Column) -> Column:
    """Bytes as B..TB with two decimals."""
    value = size.cast("double")

    def text(power: int, unit: str) -> Column:
        return F.format_string(f"%.2f {unit}", F.bround(value / F.lit(float(1024 ** power)), 2))

    ladder = F.when(size == 0, F.lit("0 B"))
    for power, unit in enumerate(["B", "KB", "MB", "GB"]):
        ladder = ladder.when(value < float(1024 ** (power + 1)), text(power, unit))
    return ladder.otherwise(text(4, "TB"))


def saved_ratio(original: Column, compressed: Column) -> Column:
    """Share of bytes saved in percent; 0 for an empty original."""
    return F.when(original > 0, (F.lit(1.0) - compressed / original) * 100).otherwise(F.lit(0.0))
