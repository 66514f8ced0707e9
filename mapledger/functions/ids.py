"""Dataset identifiers: components, publisher form, item addresses.

Component names are given as text, or as an array column where each row has its own. Functions that need the components
take them as ``parts`` too, so that a caller can split an identifier once and use it often.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapledger.functions.text import after_first, basename, json_string, needs_escape
from mapledger.schemas import DRS_FIELDS

Names = Sequence[str] | Column


def _name_array(names: Names) -> Column:
    return names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names])


def components(dataset_id: Column, names: Names) -> Column:
    """Dot-separated components; a trailing ``grid#version`` counts as two when one is missing."""
    raw = F.split(dataset_id, r"\.", -1)
    last = F.element_at(raw, -1)
    expanded = F.concat(
        F.slice(raw, 1, F.size(raw) - F.lit(1)),
        F.array(F.substring_index(last, "#", 1), F.concat(F.lit("v"), after_first(last, "#"))),
    )
    one_short = (F.size(raw) == F.size(_name_array(names)) - F.lit(1)) & last.contains("#")
    return F.when(one_short, expanded).otherwise(raw)


def components_error(dataset_id: Column, names: Names, parts: Column | None = None) -> Column:
    """Message when the component count does not fit the identifier specification."""
    parts = components(dataset_id, names) if parts is None else parts
    found, wanted = F.size(parts), F.size(_name_array(names))
    # Fixed value: message format.
    text = F.format_string(
        "Unexpected DRS format: dataset ID contains %d components, but ESGVOC defines %d DRS components: %s",
        found, wanted, dataset_id,
    )
    return F.when(found != wanted, text)


def drs_pairs(dataset_id: Column, names: Names, parts: Column | None = None) -> Column:
    """Ordered (name, value) structs; a repeated name keeps its last value. Null when the count is wrong."""
    arr, parts = _name_array(names), components(dataset_id, names) if parts is None else parts
    if isinstance(names, Column):
        last_first = F.reverse(arr)
        pairs = F.transform(
            F.array_distinct(arr),
            lambda n: F.struct(
                n.alias("name"),
                F.get(parts, (F.size(arr) - F.array_position(last_first, n)).cast("int")).alias("value"),
            ),
        )
    else:
        place = {name: i for i, name in enumerate(names)}
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.get(parts, i).alias("value")) for n, i in place.items()])
    return F.when(F.size(parts) == F.size(arr), pairs)


def drs_map(dataset_id: Column, names: Names) -> Column:
    return F.map_from_entries(drs_pairs(dataset_id, names))


def drs_json(dataset_id: Column, names: Names, parts: Column | None = None) -> Column:
    """The component mapping as JSON text, in specification order."""
    if parts is None:
        # A lambda variable holds the components, which are then split once.
        split = F.array(components(dataset_id, names))
        return F.get(F.transform(split, lambda own: drs_json(dataset_id, names, own)), 0)
    members = F.transform(
        drs_pairs(dataset_id, names, parts),
        lambda p: F.concat(json_string(p["name"]), F.lit(": "), json_string(p["value"])),
    )
    escaped = F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
    if isinstance(names, Column):
        return escaped
    # Names are escaped while planning, and an identifier of plain characters needs no escape at all.
    place = {name: i for i, name in enumerate(names)}
    texts: list[Column] = []
    for k, (name, i) in enumerate(place.items()):
        texts += [F.lit(("{" if k == 0 else '", ') + f'{json.dumps(name)}: "'), F.get(parts, i)]
    plain = F.when(F.size(parts) == len(names), F.concat(*texts, F.lit('"}')) if texts else F.lit("{}"))
    return F.when(~needs_escape(dataset_id), plain).otherwise(escaped)


def drs_prefix(dataset_id: Column, depth: str, names: Names = DRS_FIELDS) -> Column:
    """Path of the leading components down to a named depth."""
    if depth not in DRS_FIELDS:
        raise ValueError(f"Invalid archival depth: {depth}. Expected one of: {', '.join(DRS_FIELDS)}")
    arr, parts = _name_array(names), components(dataset_id, names)
    upto = F.array_position(arr, F.lit(depth)).cast("int")
    kept = F.filter(F.slice(parts, F.lit(1), upto), lambda x: x != "")
    return F.when((F.size(parts) == F.size(arr)) & (upto > 0), F.array_join(kept, "/"))


def publisher_id(dataset_id: Column) -> Column:
    """The form a publisher prints: the last ``#`` becomes ``.v``."""
    version = F.substring_index(dataset_id, "#", -1)
    base = F.left(dataset_id, F.length(dataset_id) - F.length(version) - F.lit(1))
    prefix = F.when(version.startswith("v"), F.lit(".")).otherwise(F.lit(".v"))
    return F.when(dataset_id.contains("#"), F.concat(base, prefix, version)).otherwise(dataset_id)


def percent_encode(text: Column) -> Column:
    """URL path quoting that leaves only unreserved characters."""
    out = F.url_encode(text)
    for raw, fixed in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(raw), F.lit(fixed))
    return out


def item_url(base_url: str, collection_id: Column, item_id: Column) -> Column:
    return F.concat(
        F.lit(base_url.rstrip("/") + "/collections/"), percent_encode(collection_id),
        F.lit("/items/"), percent_encode(item_id),
    )


def safe_filename(dataset_id: Column) -> Column:
    return F.replace(F.replace(dataset_id, F.lit("/"), F.lit("_")), F.lit("#"), F.lit(".v"))


def _quoted_list(items: Column) -> Column:
    quoted = F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def archive_destination(
    dataset_id: Column, mapfile: Column, project: Column, activity: Column, institution: Column,
    archive_root: Column, archive_depth: Column, names: Names, parts: Column | None = None,
) -> tuple[Column, Column]:
    """Archive path of a mapfile and, where there is none, the reason."""
    arr, parts = _name_array(names), components(dataset_id, names) if parts is None else parts
    found = F.slice(parts, 1, 3)
    expected = F.array(project, activity, institution)
    tail_names = F.slice(arr, F.lit(4), F.greatest(F.size(arr) - F.lit(3), F.lit(0)))
    upto = F.coalesce(F.array_position(tail_names, archive_depth), F.lit(0)).cast("int")
    kept = F.filter(F.slice(parts, F.lit(4), upto), lambda x: x != "")
    # Message formats.
    error = F.coalesce(
        components_error(dataset_id, names, parts),
        F.when(archive_root.isNull(), F.lit("Campaign has no archive root")),
        F.when(
            found != expected,
            F.concat(
                F.lit("Dataset "), dataset_id, F.lit(" does not match campaign DRS prefix: expected "),
                _quoted_list(expected), F.lit(", got "), _quoted_list(found),
            ),
        ),
        F.when(
            upto == 0,
            F.concat(
                F.lit("Archive depth '"), F.coalesce(archive_depth, F.lit("None")),
                F.lit("' was not found in the ESGVOC DRS specification for "), dataset_id,
            ),
        ),
    )
    path = F.concat_ws(
        "/", F.rtrim(archive_root, F.lit("/")), F.array_join(kept, "/"), F.lit(".mapfiles"), basename(mapfile)
    )
    return F.when(error.isNull(), path), error
