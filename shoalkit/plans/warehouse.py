"""Products from the normalised survey warehouse: sites, untagged fish, rare fish.

The warehouse tables arrive as DataFrames (``sources.files.read_warehouse`` reads them
over JDBC in parallel ranges; tests use landed tables). Lookups (study, gear, org,
river, person, species, disposition, sex, tag type) are small, so Catalyst broadcasts them;
encounters and the non-tagged bin are the large sides and keep their partitioning.
Fish tables are reduced to the selected sites with a semi-join on the sample number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EPSG_UTM12N
from ..functions.nulls import paste, r_round, sub_first
from ..operators.joins import assign_reach
from ..operators.projection import lower_columns
from .effort import as_of_col


def _dim(df: DataFrame, **rename) -> DataFrame:
    out = df
    for old, new in rename.items():
        out = out.withColumnRenamed(old, new)
    return out


def site_pointer(t: dict, year: int, project: str) -> DataFrame:
    """Study events of one year and project with study, gear, org, river and person."""
    study = _dim(t["study"].select("ID", "Code", "Name"), ID="StudyID", Code="StudyCode", Name="StudyName")
    gear = _dim(t["gear"].select("ID", "Code"), ID="GearTypeID", Code="GearCode")
    org = _dim(t["org"].select("ID", "Name"), ID="OrgID", Name="OrgName")
    rvr = _dim(t["hydro"].select("ID", "Code", "Name", "BasinID"), ID="RiverID", Code="rvr_code", Name="rvr_name")
    person = _dim(t["person"].select("ID", "FirstName", "LastName"), ID="PersonID")
    # a half-open range reaches the Parquet scan, year(...) = n does not
    kind = t["study_event"].schema["StartDateTime"].dataType
    start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast(kind) for y in (year, year + 1))
    ev = t["study_event"].withColumnRenamed("ID", "StudyEventID")
    ev = ev.filter((F.col("StartDateTime") >= start) & (F.col("StartDateTime") < end))
    return (ev.join(study, "StudyID", "left").join(gear, "GearTypeID", "left").join(org, "OrgID", "left")
            .join(rvr, "RiverID", "left").join(person, "PersonID", "left")
            .filter(F.col("StudyCode") == project))


def wh_site(t: dict, year: int, project: str, reach_bounds: DataFrame, reach_dim: DataFrame,
            as_of=None) -> DataFrame:
    """Site table: mid mile (as written: ``round(start + end) / 2``), principal, agency
    (first lower-case run removed from the org name), reach by river mile, reach names."""
    s = lower_columns(site_pointer(t, year, project))
    s = s.select("*", F.year("startdatetime").alias("year"),
                 (r_round(F.col("startrmi") + F.col("endrmi"), 0) / 2).alias("mid_rmi"),
                 paste("lastname", "firstname", sep=", ").alias("principal"),
                 sub_first(F.col("orgname"), "[a-z]+").alias("agency"))
    s = assign_reach(s, reach_bounds, "rvr_code", "mid_rmi", "reach")
    names = reach_dim.select(F.col("rch_code").alias("_rc"), "rch_name", F.col("rvr_code").alias("_rv"))
    s = s.join(names, (F.col("reach") == F.col("_rc")) & (F.col("rvr_code") == F.col("_rv")), "inner")
    return s.select(
        F.col("samplenumber").alias("site_id"), F.col("studycode").alias("project_code"), "year", "rvr_name",
        "rch_name", "rvr_code", F.col("reach").alias("rch_code"), "pass", "startdatetime", "enddatetime",
        F.col("startrmi").alias("start_rmi"), F.col("endrmi").alias("end_rmi"),
        F.col("electrofishingseconds").alias("el_sec"), "shoreline", "boat", "crew",
        F.col("notes").alias("site_notes"), F.col("conductivity").alias("cond_amb"),
        F.lit(None).cast("int").alias("cond_spec"), F.col("rivertemperature").alias("rvr_temp"),
        F.col("turbidity").alias("secchi"), F.lit(None).cast("string").alias("water_notes"), "principal",
        "agency", F.col("gearcode").alias("gear"), as_of_col(as_of).alias("last_modified"))


def _epsg(x: str = "utmx"):
    return F.when(F.col(x).isNotNull(), F.lit(EPSG_UTM12N))


def wh_untagged(t: dict, site_p: DataFrame) -> DataFrame:
    """Non-tagged fish of the selected sites, with species names (inner on the code)."""
    spp = _dim(t["species"].select("Code", "CommonName", "ScientificName"), Code="Species")
    n = (t["ntf"].join(site_p.select("SampleNumber"), "SampleNumber", "left_semi").join(spp, "Species", "inner"))
    n = lower_columns(n)
    return n.select(
        F.col("samplenumber").alias("site_id"), "datetime", F.col("rivermile").alias("rmi"),
        F.col("species").alias("spp_code"), F.col("commonname").alias("com_name"),
        F.col("scientificname").alias("sci_name"), F.col("length").alias("tot_length"), "weight", "sex", "ripe",
        F.lit(None).cast("string").alias("tubercles"), F.lit(None).cast("int").alias("ray_ct"),
        F.col("dispositiontype").alias("disp_code"), F.col("utmx").alias("loc_x"), F.col("utmy").alias("loc_y"),
        _epsg().alias("epsg"), F.col("floytag1").alias("floy_num_1"), F.col("floytag1color").alias("floy_color_1"),
        F.col("recap1").alias("floy_recap_1"), F.col("floytag2").alias("floy_num_2"),
        F.col("floytag2color").alias("floy_color_2"), F.col("recap2").alias("floy_recap_2"),
        F.col("notes").alias("fish_notes"))


def wh_rare(t: dict, site_p: DataFrame) -> DataFrame:
    """Encounters of tagged individuals at the selected sites with tag, species,
    disposition and sex codes."""
    enc = t["encounter"].withColumnRenamed("ID", "EncounterID").withColumnRenamed("Notes", "EncounterNotes")
    ind = t["individual"].withColumnRenamed("ID", "IndividualID")
    tag_type = _dim(t["tag_type"].select("ID", "TagType"), ID="TagTypeID")
    tag = (t["tag"].withColumnRenamed("ID", "TagID").withColumnRenamed("TagType", "TagTypeID")
           .join(tag_type, "TagTypeID", "left"))
    spp = _dim(t["species"].select("ID", "Code", "CommonName", "ScientificName"), ID="SpeciesID", Code="SpeciesCode")
    disp = _dim(t["disposition"].select("ID", "Code"), ID="DispositionTypeID", Code="DispositionTypeCode")
    sex = _dim(t["sex"].select("ID", "Code"), ID="Sex", Code="SexCode")
    r = (enc.join(ind, "IndividualID", "left").join(site_p.select("SampleNumber"), "SampleNumber", "left_semi")
         .join(tag, "IndividualID", "left").join(spp, "SpeciesID", "left").join(disp, "DispositionTypeID", "left")
         .join(sex, "Sex", "left"))
    r = lower_columns(r)
    return r.select(
        F.col("samplenumber").alias("site_id"), F.col("encounterdatetime").alias("datetime"),
        F.col("rivermile").alias("rmi"), F.col("speciescode").alias("spp_code"),
        F.col("commonname").alias("com_name"), F.col("scientificname").alias("sci_name"),
        F.col("length").alias("tot_length"), "weight", F.col("sexcode").alias("sex"), F.col("ripeflag").alias("ripe"),
        F.col("tuberclesflag").alias("tubercles"), F.col("raycount").alias("ray_ct"),
        F.col("dispositiontypecode").alias("disp_code"), F.col("utmx").alias("loc_x"), F.col("utmy").alias("loc_y"),
        _epsg().alias("epsg"), F.col("encounternotes").alias("fish_notes"), F.col("recapture").alias("pit_recap"),
        F.col("tagcode").alias("pit_num"), F.col("tagtype").alias("pit_type"))


def wh_fish(rare: DataFrame, untagged: DataFrame) -> DataFrame:
    """Rare and untagged fish stacked by name; a 0 Floy recapture is NULL and a missing
    PIT recapture is FALSE."""
    f = rare.unionByName(untagged, allowMissingColumns=True)
    return f.withColumns({
        "floy_recap_1": F.nullif(F.col("floy_recap_1"), F.lit(0)),
        "floy_recap_2": F.nullif(F.col("floy_recap_2"), F.lit(0)),
        "pit_recap": F.coalesce(F.col("pit_recap"), F.lit(False)),
    })
