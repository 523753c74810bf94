"""The user-level jobs. Each writes its tables and returns their paths and row counts.

Layout under `root`: bronze/ (landed text), silver/ (linked waves), backbone/ (versions, which
hold the quarantine as well; "root/backbone@2" names the second), gold/ (releases, partitioned by
group) and codebook/. Typed waves are staged in the shared folder.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.blank import not_blank
from ..operators.history import backbone_changes, create_backbone
from ..operators.identity import identify
from ..operators.link import match_cascade
from ..operators.profile import dataset_bytes, dataset_dims, dictionary_coverage, profile_columns
from ..operators.release import release_projection, subset_by_backbone, subset_by_codes
from ..operators.shape import as_date, forbid_columns
from ..session import tune
from ..sources.bronze import Landed, land_bronze, landed_file, landed_rows
from ..sources.delimited import CORRUPT, scan_delimited
from ..sources.dictionary import codebook, load_dictionary, write_codebook, write_records
from ..sources.tables import scan_table, stage, write_table
from ..sources.versions import Version, commit_base, commit_changes, committed, read_backbone, read_rows, total_rows
from ..specs.model import SourceSpec
from .standardise import standardise


@dataclass(frozen=True)
class Wave:
    """One delivered file (or set of files) of a source."""
    path: str
    source: str
    wave_date: str
    file_id: str
    loaded_on: str


def _land(spark: SparkSession, wave: Wave, separator: str, root: str, processor: str) -> int:
    """Land the lines of a file as text. Lines that do not fit the header are landed as well,
    whole, in the column CORRUPT."""
    header = scan_delimited(spark, wave.path, separator).columns
    raw = scan_delimited(spark, wave.path, separator, header, keep_corrupt=True)
    return land_bronze(raw, f"{root}/bronze/{wave.source}", source=wave.source, wave_date=wave.wave_date, file_id=wave.file_id,
                       received_on=wave.loaded_on, processor=processor)


def _typed(spark, source: str, file_id: str, spec: SourceSpec, root: str, secret: str, code_tables) -> tuple[DataFrame, int, Landed]:
    """Typed rows of the lines of a landed file that fit, staged, the number of lines that do not,
    and the file's line of the manifest."""
    path = f"{root}/bronze/{source}"
    file = landed_file(spark, path, file_id)
    landed = landed_rows(spark, path, file)
    df = standardise(landed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), spec, source=source, wave_date=file.wave_date,
                     file_id=file_id, loaded_on=file.received_on, secret=secret, code_tables=code_tables)
    return stage(df, f"{source}-{file.wave_date}"), landed.where(F.col(CORRUPT).isNotNull()).count(), file


def _write_silver(linked: DataFrame, file: Landed, root: str, mode: str = "errorifexists") -> tuple[str, int]:
    """Matched and unmatched rows as two partitions, `linked=true` and `linked=false`."""
    path = f"{root}/silver/{file.source}_{file.wave_date}"
    rows = linked.withColumn("linked", not_blank(linked, "entity_id"))
    return path, write_table(rows, path, ["linked"], mode=mode)


def import_register(spark: SparkSession, wave: Wave, spec: SourceSpec, root: str, secret: str,
                    backbone: str | None = None, code_tables: dict | None = None) -> dict:
    """Land and type a register wave, create the backbone from it or update the given
    version with it, and write the linked wave."""
    tune(spark)
    _land(spark, wave, spec.separator, root, "register import")
    return register_wave(spark, wave.source, wave.file_id, spec, root, secret, backbone, code_tables)


def register_wave(spark: SparkSession, source: str, file_id: str, spec: SourceSpec, root: str, secret: str, backbone: str | None = None,
                  code_tables: dict | None = None, batch: str | None = None) -> dict:
    """The same for a wave that is landed already.

    With `batch`, a run can be repeated: the version's commit comes last, what an earlier run of the
    batch left without it is replaced, and a committed batch changes nothing, which the result
    says by `silver` None.
    """
    tune(spark)
    store = f"{root}/backbone"
    done = committed(spark, store, batch) if batch else None
    if done:
        return {"backbone": str(done), "backbone_rows": total_rows(spark, done), "silver": None, "silver_rows": 0, "rejected_lines": 0}
    src, rejected, file = _typed(spark, source, file_id, spec, root, secret, code_tables)
    columns, as_of = list(spec.backbone), as_date(file.received_on, "loaded_on")
    batch, mode = (batch, "overwrite") if batch else (str(uuid.uuid4()), "errorifexists")
    if backbone is None:
        checked = stage(create_backbone(src, columns, secret, as_of), "backbone")
        linked = match_cascade(src, checked.where("is_valid").drop("is_valid"), list(spec.passes))
        silver, linked_rows = _write_silver(linked, file, root, mode)
        version = commit_base(checked, store, batch)
    else:
        parent = Version.of(spark, backbone)
        linked = identify(src, read_backbone(spark, parent), secret, list(spec.passes))
        silver, linked_rows = _write_silver(linked, file, root, mode)
        changes = backbone_changes(scan_table(spark, silver), read_rows(spark, parent), columns, list(spec.dedupe), as_of)
        version = commit_changes(changes, parent, batch)
    return {"backbone": str(version), "backbone_rows": total_rows(spark, version), "silver": silver, "silver_rows": linked_rows,
            "rejected_lines": rejected}


def link_survey(spark: SparkSession, wave: Wave, spec: SourceSpec, root: str, secret: str, backbone: str,
                code_tables: dict | None = None) -> dict:
    """Land and type a survey wave and link it to the backbone."""
    tune(spark)
    _land(spark, wave, spec.separator, root, "survey link")
    src, rejected, file = _typed(spark, wave.source, wave.file_id, spec, root, secret, code_tables)
    linked = match_cascade(src, read_backbone(spark, backbone), list(spec.passes))
    forbid_columns(linked, spec.deny)
    silver, rows = _write_silver(linked, file, root)
    return {"silver": silver, "silver_rows": rows, "rejected_lines": rejected}


def _matched(spark: SparkSession, silver: str) -> DataFrame:
    return scan_table(spark, silver, ["linked"]).where("linked").drop("linked")


def release_register(spark: SparkSession, silver: str, spec: SourceSpec, groups: dict, target: str) -> int:
    """All subsets of a register wave in one pass, as partitions of `release_group`."""
    tune(spark)
    released = release_projection(_matched(spark, silver), list(spec.release), spec.release_deny)
    return write_table(subset_by_codes(released, "code_legal_form", groups), target, ["release_group"],
                       reads=[silver])


def release_survey(spark: SparkSession, silver: str, backbone: str, spec: SourceSpec, groups: dict,
                   target: str, active: bool = True) -> int:
    """All subsets of a survey wave by the legal form of its entities in the backbone."""
    tune(spark)
    released = release_projection(_matched(spark, silver), list(spec.release), spec.release_deny)
    subsets = subset_by_backbone(released, read_backbone(spark, backbone), "code_legal_form", groups, active)
    return write_table(subsets, target, ["release_group"], reads=[silver, Version.of(spark, backbone).root])


def build_codebook(spark: SparkSession, table: str, dictionary: str, target: str, format: str = "xml",
                   approx: bool = False) -> DataFrame:
    """Profile a released table, join its dictionary, and write the codebook.

    Variables go to `target`; the study block, the file block (rows, columns, files, bytes) and the
    coverage of the dictionary (undocumented and orphan columns) go to folders beside it, named
    `target` with -study, -file and -coverage.
    """
    tune(spark)
    data = scan_table(spark, table)
    study, columns, labels = load_dictionary(spark, dictionary)
    book = stage(codebook(profile_columns(data, approx), columns, labels), "codebook")
    write_codebook(book, target, format)
    name = F.lit(os.path.basename(table.rstrip("/"))).alias("dataset")
    file = dataset_dims(data, os.path.basename(table.rstrip("/"))).join(dataset_bytes(data).select(name, "*"), "dataset")
    write_records(study, f"{target}-study", "stdyDscr", format)
    write_records(file, f"{target}-file", "fileDscr", format)
    write_records(dictionary_coverage(data, columns), f"{target}-coverage", "coverage", format)
    return book
