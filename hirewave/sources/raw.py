"""Raw-zone reads across producers whose files disagree on the skills column.

Different column *names* (``HARD SKILLS`` / ``HARD_SKILLS#0``) merge in one
scan with the merged schema.  The same name with different *types* (printed
text in some files, true arrays in others) cannot be read by one scan; then
the files of the requested dates are grouped by their own schema, each group
is read by one scan and its skills parsed by its own names and type, and the
groups are unioned into one frame.  The data work is still one Spark job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.functions import rules
from hirewave.operators import clean, skills
from hirewave.sources import crawl, listing, partitions

P = rules.PARTITION_COLUMNS


def read_crawled(spark: SparkSession, root: str, files: DataFrame, skills_mode: str = "row") -> tuple[DataFrame, str]:
    """Rows of crawled ``files`` (see ``sources.crawl``) -> (frame, skills mode for ``silver.build``).

    Schemas come from the crawl, so planning opens no footer.  Files that
    agree on every type are one scan, and the mode is ``skills_mode`` (skills
    still to parse).  Otherwise each group of equal schema is read by a scan of
    its own, its skills parsed by its own names and type, row by row, and the
    mode is ``"parsed"``; any other ``skills_mode`` raises there.
    """
    schema, torn = crawl.merged_schema(crawl.kinds(files))
    if not torn:
        dates = [tuple(r) for r in files.select(*P).distinct().orderBy(*P).collect()]  # bounded by the calendar
        return crawl.read_group(spark, root, schema, [listing.date_dir(root, *d) for d in dates]), skills_mode
    if skills_mode != "row":
        raise ValueError(f"mode {skills_mode!r} needs one type for each column; these files differ in {', '.join(torn)}, use mode 'row'")
    frames = [skills.parse_skills(clean.resolve_aliases(crawl.read_group(spark, root, kind, paths)))
              for kind, paths in crawl.groups(spark, root, files)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out, "parsed"


def read_dates(spark: SparkSession, root: str, dates: DataFrame, skills_mode: str = "row") -> tuple[DataFrame, str]:
    """Rows of the listed dates, without a registry of footers: those of the dates' files are read now."""
    keys = sorted({tuple(r) for r in dates.select(*P).collect()})  # bounded by the calendar
    files = crawl.footers(listing.list_files(spark, root, keys)).persist()
    try:
        if files.isEmpty():
            return partitions.read_partitioned(spark, root).where(F.lit(False)), skills_mode
        return read_crawled(spark, root, files, skills_mode)
    finally:
        files.unpersist()
