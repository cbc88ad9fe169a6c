"""Families, pedigrees and phenotype documents.

Family logic is expressed as joins against the *first proband* of each family
(or analysis) instead of per-family Python loops, so every step is a shuffle on
the family key. Only the document builders gather one family's members into
an array, which is the document they produce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import first_by, literal_map
from strandline.operators.catalog import s3_parts

# Fixed values that must equal the reference's (earliest to latest onset).
ONSET_DEFAULT = "HP:0003674"
ONSET_ORDER = [
    "HP:0030674",  # Antenatal
    "HP:0003577",  # Congenital
    "HP:0003623",  # Neonatal
    "HP:0003593",  # Infantile
    "HP:0011463",  # Childhood
    "HP:0003621",  # Juvenile
    "HP:0011462",  # Young adult
    "HP:0003596",  # Middle age
    "HP:0003584",  # Senior
]
API_SEX = {"male": "M", "female": "F", "other": "M", "unknown": "M"}
API_SEX_DEFAULT = "M"
PEDIGREE_SEX = {"Male": "MALE", "Female": "FEMALE", "unknown": "UNKNOWN_SEX", "other": "OTHER_SEX"}
AFFECTED_CODE = {"affected": "AFFECTED", "not_affected": "UNAFFECTED", "unknown": "MISSING"}
FAMILY_KEYWORD = "family"
NAME_SEPARATOR = " - "


def _filled(c: str) -> Column:
    """Python truthiness of an optional string id."""
    return F.coalesce(F.length(F.col(c)), F.lit(0)) > 0


def first_proband(clinical: DataFrame, key: str = "family_id") -> DataFrame:
    """The first proband row per ``key`` (by sequencing id), parent ids renamed."""
    probands = clinical.where(F.col("is_proband") & F.col(key).isNotNull()).select(
        key, "sequencing_id", "aliquot_id", "father_aliquot_id", "mother_aliquot_id")
    return first_by(probands, [key], [F.col("sequencing_id")]).select(
        key, F.col("sequencing_id").alias("p_sequencing_id"), F.col("aliquot_id").alias("p_aliquot_id"),
        F.col("father_aliquot_id").alias("p_father"), F.col("mother_aliquot_id").alias("p_mother"))


def split_families(clinical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a family id, rows without one)."""
    return clinical.where(F.col("family_id").isNotNull()), clinical.where(F.col("family_id").isNull())


def family_sizes(families: DataFrame) -> DataFrame:
    return families.groupBy("family_id").agg(F.count("*").alias("n_members"))


def _in_parents(p_father: str = "p_father", p_mother: str = "p_mother") -> Column:
    a = F.col("aliquot_id").cast("string")
    return F.coalesce(a == F.col(p_father).cast("string"), F.lit(False)) | \
        F.coalesce(a == F.col(p_mother).cast("string"), F.lit(False))


def supported_families(clinical: DataFrame) -> DataFrame:
    """Members kept for a family case: the first proband plus the members whose
    aliquot (compared as strings) is one of the proband's parents. Families
    without a proband, or whose proband names no parent, are dropped."""
    fam, _ = split_families(clinical)
    p = first_proband(fam)
    j = fam.join(p, "family_id")
    keep = (F.col("p_father").isNotNull() | F.col("p_mother").isNotNull()) & (
        (F.col("sequencing_id") == F.col("p_sequencing_id")) | (~F.col("is_proband") & _in_parents()))
    return j.where(keep).drop("p_sequencing_id", "p_aliquot_id", "p_father", "p_mother")


def dropped_members(clinical: DataFrame) -> DataFrame:
    """Audit rows: non-proband members with parent ids of their own that are
    not the proband's parents (siblings), in families that have a proband."""
    fam, _ = split_families(clinical)
    j = fam.join(first_proband(fam), "family_id")
    return j.where(~F.col("is_proband") & ~_in_parents() &
                   (_filled("father_aliquot_id") | _filled("mother_aliquot_id"))).drop(
        "p_sequencing_id", "p_aliquot_id", "p_father", "p_mother")


def solo_duo_trio(clinical: DataFrame, signs: DataFrame) -> DataFrame:
    """Analyses runnable as SOLO/DUO/TRIO: a proband with at least one clinical
    sign, at least one SNV or CNV file, and no sibling anywhere."""
    facts = clinical.groupBy("analysis_id").agg(
        F.bool_or("is_proband").alias("has_proband"),
        F.bool_or(~F.col("is_proband") & (_filled("father_aliquot_id") | _filled("mother_aliquot_id")))
        .alias("has_sibling"),
        F.bool_or(_filled("snv_url") | _filled("cnv_url")).alias("has_vcf"))
    p = first_proband(clinical, "analysis_id")
    with_sign = p.join(signs.select(F.col("sequencing_id").alias("p_sequencing_id")), "p_sequencing_id", "left_semi")
    return (facts.where(F.col("has_proband") & ~F.col("has_sibling") & F.col("has_vcf"))
            .join(with_sign.select("analysis_id"), "analysis_id", "left_semi").select("analysis_id"))


def with_a_parent(clinical: DataFrame) -> DataFrame:
    """All rows of analyses in which some row names a father or a mother."""
    keys = (clinical.where(F.col("father_aliquot_id").isNotNull() | F.col("mother_aliquot_id").isNotNull())
            .select("analysis_id").distinct())
    return clinical.join(keys, "analysis_id", "left_semi")


def relation(aliquot: Column, proband: Column, father: Column, mother: Column) -> Column:
    """father, then mother, then proband; NULL when none applies."""
    return (F.when(aliquot == father, "father").when(aliquot == mother, "mother")
            .when(aliquot == proband, "proband"))


def with_relation(members: DataFrame, key: str = "family_id", strict: bool = False) -> DataFrame:
    """Attach ``relation`` of each member to the family's first proband."""
    p = first_proband(members, key)
    rel = relation(F.col("aliquot_id"), F.col("p_aliquot_id"), F.col("p_father"), F.col("p_mother"))
    if strict:
        rel = F.coalesce(rel, F.raise_error(F.concat(F.lit("Missing relation for aliquot "), F.col("aliquot_id"))))
    return members.join(p, key, "left").withColumn("relation", rel)


def file_roles(clinical: DataFrame) -> DataFrame:
    """One row per (member, file kind) with the third-party file role:
    patient / maternal / paternal + ``_called_`` + snv / cnv."""
    p = first_proband(clinical, "analysis_id")
    j = clinical.join(p, "analysis_id", "left")
    who = (F.when(F.col("is_proband"), "patient")
           .when(F.coalesce(F.col("aliquot_id") == F.col("p_mother"), F.lit(False)), "maternal")
           .otherwise("paternal"))
    files = F.array(F.struct(F.lit("snv").alias("kind"), F.col("snv_url").alias("url")),
                    F.struct(F.lit("cnv").alias("kind"), F.col("cnv_url").alias("url")))
    return (j.select("analysis_id", "aliquot_id", who.alias("_who"), F.inline(files))
            .where(F.col("url").isNotNull())
            .select("analysis_id", "aliquot_id", F.concat("_who", F.lit("_called_"), "kind").alias("file_role"), "url"))


def parental_affected(clinical: DataFrame) -> DataFrame:
    """On each analysis' proband: affected status of the mother and the father
    (default false). An aliquot equal to both parents counts as the mother."""
    p = first_proband(clinical, "analysis_id")
    m = clinical.select("analysis_id", F.col("aliquot_id").alias("_a"), F.col("affected_status").alias("_aff"))
    mother = (p.join(m, (p["analysis_id"] == m["analysis_id"]) & (m["_a"] == p["p_mother"]))
              .groupBy(p["analysis_id"]).agg(F.bool_or("_aff").alias("maternal_affected")))
    father = (p.join(m, (p["analysis_id"] == m["analysis_id"]) & (m["_a"] == p["p_father"]) &
                     ~F.coalesce(m["_a"] == p["p_mother"], F.lit(False)))
              .groupBy(p["analysis_id"]).agg(F.bool_or("_aff").alias("paternal_affected")))
    return (p.join(mother, "analysis_id", "left").join(father, "analysis_id", "left")
            .select("analysis_id", F.col("p_sequencing_id").alias("sequencing_id"),
                    F.coalesce("maternal_affected", F.lit(False)).alias("maternal_affected"),
                    F.coalesce("paternal_affected", F.lit(False)).alias("paternal_affected")))


def coerce_parent_sex(clinical: DataFrame) -> DataFrame:
    """Pedigree sex per member: an unknown sex becomes MALE for someone named as
    a father in the same analysis, FEMALE for a mother (father test first)."""
    fathers = (clinical.where(F.col("father_aliquot_id").isNotNull())
               .select("analysis_id", F.col("father_aliquot_id").alias("aliquot_id")).distinct()
               .withColumn("_is_father", F.lit(True)))
    mothers = (clinical.where(F.col("mother_aliquot_id").isNotNull())
               .select("analysis_id", F.col("mother_aliquot_id").alias("aliquot_id")).distinct()
               .withColumn("_is_mother", F.lit(True)))
    mapped = literal_map(PEDIGREE_SEX)[F.col("gender")]
    sex = (F.when(mapped.isNull() | (mapped != "UNKNOWN_SEX"), mapped)
           .when(F.col("_is_father"), "MALE").when(F.col("_is_mother"), "FEMALE").otherwise(mapped))
    return (clinical.join(fathers, ["analysis_id", "aliquot_id"], "left")
            .join(mothers, ["analysis_id", "aliquot_id"], "left")
            .withColumn("pedigree_sex", sex).drop("_is_father", "_is_mother"))


def api_sex(gender: Column) -> Column:
    return F.coalesce(literal_map(API_SEX)[F.lower(gender)], F.lit(API_SEX_DEFAULT))


def affected_code(affected_status: Column) -> Column:
    """Boolean affected status to the clinical code."""
    return F.when(affected_status, "affected").when(~affected_status, "not_affected").otherwise("unknown")


def recode_affected(code: Column) -> Column:
    return literal_map(AFFECTED_CODE)[code]


def sign_ids(signs: DataFrame, affected_only: bool = False, key: str = "sequencing_id", order: str | None = None,
             persons: DataFrame | None = None, absent: str = "null") -> DataFrame:
    """Per person, the list of HPO ids (optionally of affected signs only; signs without an id are left out), in the order of
    the column ``order``, by id without one. With ``persons`` (key) there is a row for everyone named there: one without signs
    has NULL, or an empty list with ``absent="empty"``."""
    if absent not in ("null", "empty"):
        raise ValueError(absent)
    s = signs.where(F.col("affected_status")) if affected_only else signs
    s = s.where(F.col("hpo_id").isNotNull())
    if order is None:
        ids = F.sort_array(F.collect_list("hpo_id"))
    else:
        ids = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "hpo_id"))), lambda x: x["hpo_id"])
    out = s.groupBy(key).agg(ids.alias("hpo_ids"))
    if persons is None:
        return out
    out = persons.select(key).distinct().join(out, key, "left")
    return out if absent == "null" else out.withColumn("hpo_ids", F.coalesce("hpo_ids", F.array().cast("array<string>")))


def earliest_onset(signs: DataFrame, key: str = "sequencing_id") -> DataFrame:
    """Per person, the earliest onset code of the fixed hierarchy, or NULL."""
    rank = literal_map({code: str(i) for i, code in enumerate(ONSET_ORDER)})
    ranked = signs.where(F.col("age_at_onset").isNotNull()).select(
        key, "age_at_onset", rank[F.col("age_at_onset")].cast("int").alias("_rank"))
    return (ranked.where(F.col("_rank").isNotNull()).groupBy(key)
            .agg(F.min_by("age_at_onset", "_rank").alias("onset")))


def onset_or_default(onset: Column) -> Column:
    return F.coalesce(onset, F.lit(ONSET_DEFAULT))


def pedigree_documents(clinical: DataFrame, signs: DataFrame, analyses: DataFrame | None = None) -> DataFrame:
    """One JSON family document per proband: subject, affected phenotypic
    features, and the pedigree persons of its analysis."""
    c = clinical if analyses is None else clinical.join(analyses, "analysis_id", "left_semi")
    members = coerce_parent_sex(c)
    persons = members.groupBy("analysis_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("aliquot_id").alias("individualId"),
        F.col("analysis_id").alias("familyId"),
        F.col("pedigree_sex").alias("sex"),
        recode_affected(affected_code(F.col("affected_status"))).alias("affectedStatus"),
        F.col("father_aliquot_id").alias("paternalId"),
        F.col("mother_aliquot_id").alias("maternalId")))).alias("persons"))
    probands = c.where("is_proband")
    label = F.col("name") if "name" in signs.columns else F.lit(None).cast("string")
    feats = (signs.where("affected_status AND hpo_id IS NOT NULL").groupBy("sequencing_id")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("hpo_id").alias("id"), label.alias("label")))).alias("features")))
    family = F.struct(
        F.col("analysis_id").alias("id"),
        F.struct(F.struct(F.col("aliquot_id").alias("id"), literal_map(PEDIGREE_SEX)[F.col("gender")].alias("sex")).alias("subject"),
                 F.transform(F.coalesce("features", F.array()), lambda f: F.struct(f.alias("type"))).alias("phenotypicFeatures"))
        .alias("proband"),
        F.struct(F.col("persons")).alias("pedigree"))
    doc = (probands.join(feats, "sequencing_id", "left").join(persons, "analysis_id")
           .select("analysis_id", "aliquot_id", family.alias("family")))
    return doc.select("analysis_id", "aliquot_id", "family", F.to_json(_without_defaults(F.col("family"))).alias("document"))


def _without_defaults(family: Column) -> Column:
    """A family as its JSON form has it: without values that are a field's default (unknown sex, missing status, no features)."""
    subject, features = family["proband"]["subject"], family["proband"]["phenotypicFeatures"]
    person = lambda p: F.struct(
        p["familyId"].alias("familyId"), p["individualId"].alias("individualId"), p["paternalId"].alias("paternalId"),
        p["maternalId"].alias("maternalId"), F.nullif(p["sex"], F.lit("UNKNOWN_SEX")).alias("sex"),
        F.nullif(p["affectedStatus"], F.lit("MISSING")).alias("affectedStatus"))
    return F.struct(
        family["id"].alias("id"),
        F.struct(F.struct(subject["id"].alias("id"), F.nullif(subject["sex"], F.lit("UNKNOWN_SEX")).alias("sex")).alias("subject"),
                 F.when(F.size(features) > 0, features).alias("phenotypicFeatures")).alias("proband"),
        F.struct(F.transform(family["pedigree"]["persons"], person).alias("persons")).alias("pedigree"))


def sample_name(aliquot: Column, analysis: Column) -> Column:
    """``"{aliquot} - {analysis}"``; a missing part prints as ``None``."""
    return F.concat(F.coalesce(aliquot, F.lit("None")), F.lit(NAME_SEPARATOR), F.coalesce(analysis, F.lit("None")))


def name_aliquot(name: Column) -> Column:
    part = F.trim(F.split_part(name, F.lit(NAME_SEPARATOR), F.lit(1)))
    return F.nullif(part, F.lit(FAMILY_KEYWORD))


def name_analysis(name: Column) -> Column:
    part = F.trim(F.split_part(name, F.lit(NAME_SEPARATOR), F.lit(2)))
    part = F.when(part.contains("_"), F.substring_index(part, "_", 1)).otherwise(part)
    return F.nullif(part, F.lit("None"))


def _case_members(clinical: DataFrame) -> DataFrame:
    """Members of each third-party case: supported family members (case = the
    proband's analysis) and SOLO probands (rows without a family)."""
    about = [F.col(c).cast("string").alias(c) if c in clinical.columns else F.lit(None).cast("string").alias(c)
             for c in ("first_name", "birth_date")]
    fam = supported_families(clinical)
    p = first_proband(fam).join(
        fam.select("family_id", F.col("sequencing_id").alias("p_sequencing_id"),
                   F.col("analysis_id").alias("case_id")), ["family_id", "p_sequencing_id"])
    fm = fam.join(p, "family_id").select(
        "case_id", F.lit("family").alias("kind"), "sequencing_id", "aliquot_id", "affected_status", "gender", *about,
        relation(F.col("aliquot_id"), F.col("p_aliquot_id"), F.col("p_father"), F.col("p_mother")).alias("relation"),
        F.col("p_sequencing_id").alias("proband_seq"))
    solo = clinical.where(F.col("family_id").isNull() & F.col("is_proband")).select(
        F.col("analysis_id").alias("case_id"), F.lit("solo").alias("kind"), "sequencing_id", "aliquot_id",
        "affected_status", "gender", *about, F.lit("proband").alias("relation"), F.col("sequencing_id").alias("proband_seq"))
    return fm.unionByName(solo)


# Fixed values of the case service's requests.
TISSUE_TYPE = "Whole Blood"
VCF_FILE_TYPE = "VCF_SHORT"


def case_requests(clinical: DataFrame, signs: DataFrame, files: DataFrame, listing: DataFrame | None = None, env: str = "prod",
                  bucket: str = "franklin", assay_id: str = "", order: str | None = None) -> DataFrame:
    """One request document per case, ready to send: where the files are, every sample with its file below
    ``{env}/{analysis}/`` and its patient, and for families only the family block with the proband's phenotypes and the order to
    create the single analyses too. ``files``: (sequencing_id, vcf_key); ``listing``: the keys of the service's bucket.

    A case whose sample has no file, or (with ``listing``) one that is not there, has an ``error`` instead of a request; of
    several the first by sample name is told. ``order`` as in :func:`sign_ids`. ``clinical`` may have first_name and birth_date.
    """
    key = F.concat(F.lit(f"{env}/"), F.col("case_id"), F.lit("/"), F.col("vcf_key"))
    m = _case_members(clinical).join(files.select("sequencing_id", "vcf_key"), "sequencing_id", "left").withColumn(
        "sample_name", sample_name(F.col("aliquot_id"), F.col("case_id"))).withColumn("key", key)
    if listing is None:
        m = m.withColumn("_there", F.lit(True))
    else:
        m = m.join(listing.select(F.col("object_key").alias("key")).distinct().withColumn("_there", F.lit(True)), "key", "left")
    m = m.withColumn("error", F.when(F.col("vcf_key").isNull(), F.concat(
        F.lit("No VCF to attach for aliquot_id "), F.coalesce("aliquot_id", F.lit("None")))).when(
        F.col("_there").isNull(), F.concat(F.lit(f"VCF not found: {bucket}/"), F.col("key"))))
    samples = m.groupBy("case_id", "kind", "proband_seq").agg(F.sort_array(F.collect_list(F.struct(
        "sample_name", F.col("relation").alias("family_relation"), F.col("affected_status").alias("is_affected"),
        F.col("aliquot_id").alias("name_in_vcf"), "vcf_key", "gender", "key", "first_name", "birth_date", "error"))).alias("samples"))
    pheno = sign_ids(signs, order=order).select(F.col("sequencing_id").alias("proband_seq"), F.col("hpo_ids").alias("phenotypes"))
    j = samples.join(pheno, "proband_seq", "left").withColumn(
        "phenotypes", F.coalesce("phenotypes", F.array().cast("array<string>"))).withColumn(
        "error", F.get(F.array_compact(F.transform("samples", lambda s: s["error"])), F.lit(0)))
    uploads = F.struct(F.lit("AWS").alias("source"),
                       F.struct(F.lit(bucket).alias("bucket"), F.lit("/").alias("root_folder")).alias("details"))
    analyses = F.transform("samples", lambda s: F.struct(F.lit(assay_id).alias("assay_id"), F.struct(
        s["sample_name"].alias("sample_name"), s["name_in_vcf"].alias("name_in_vcf"),
        F.array(F.struct(s["key"].alias("key"), F.lit(VCF_FILE_TYPE).alias("type"))).alias("aws_files"),
        F.lit(TISSUE_TYPE).alias("tissue_type"),
        F.struct(s["first_name"].alias("name"), F.coalesce(s["birth_date"], F.lit("None")).alias("dob"), s["gender"].alias("sex"))
        .alias("patient_details")).alias("sample_data")))
    family = F.array(F.struct(
        F.concat(F.lit(FAMILY_KEYWORD + NAME_SEPARATOR), F.col("case_id")).alias("case_name"),
        F.transform("samples", lambda s: F.struct(s["sample_name"].alias("sample_name"),
                                                  s["family_relation"].alias("family_relation"),
                                                  s["is_affected"].alias("is_affected"))).alias("family_samples"),
        F.col("phenotypes").alias("phenotypes")))
    creation = F.struct(F.lit("true").alias("create_family_single_analyses"))
    is_family, ok = F.col("kind") == "family", F.col("error").isNull()
    single = [uploads.alias("upload_specs"), analyses.alias("analyses")]
    request = F.struct(*single, F.when(is_family, family).alias("family_analyses"),
                       F.when(is_family, creation).alias("family_analyses_creation_specs"))
    keep = {"ignoreNullFields": "false"}  # unknown values are null, but a SOLO case has no family block at all
    document = F.when(is_family, F.to_json(request, keep)).otherwise(F.to_json(F.struct(*single), keep))
    return j.select("case_id", "kind", "samples", "phenotypes", F.when(ok, request).alias("request"),
                    F.when(ok, document).alias("document"), "error")


# Fixed value: how the phenotype service fetches files.
DOWNLOAD_SOURCE = "s3_minio"


def phenotype_requests(clinical: DataFrame, signs: DataFrame, bucket: str = "phenovar-import", names: DataFrame | None = None,
                       order: str | None = None) -> DataFrame:
    """Phenotype-service request per runnable analysis (SOLO/DUO/TRIO): proband
    external id and sex, parents' affected status, HPO list, earliest onset, where to download from, and the analysis files
    ``{analysis}/{file}`` with their roles. ``names``: (url, file_name) of files whose copies are named otherwise than the
    last part of the URL (see :func:`catalog.file_names`).

    An analysis with a file whose URL cannot be read has ``error`` (all of them, by aliquot) instead of a request. Empty URLs
    and the text ``None`` stand for no file. ``order`` as in :func:`sign_ids`."""
    ok = solo_duo_trio(clinical, signs)
    c = clinical.join(ok, "analysis_id", "left_semi")
    p = first_proband(c, "analysis_id").join(
        c.select(F.col("sequencing_id").alias("p_sequencing_id"), "gender"), "p_sequencing_id")
    pa = parental_affected(c).select("analysis_id", "maternal_affected", "paternal_affected")
    hpo = sign_ids(signs, order=order).select(F.col("sequencing_id").alias("p_sequencing_id"), F.col("hpo_ids").alias("hpo"))
    onset = earliest_onset(signs).select(F.col("sequencing_id").alias("p_sequencing_id"), "onset")
    roles = file_roles(c).where((F.length("url") > 0) & (F.col("url") != "None"))
    _, key, bad = s3_parts(F.col("url"))
    name = F.substring_index(key, "/", -1)
    if names is not None:
        roles = roles.join(names.select("url", "file_name").distinct(), "url", "left")
        name = F.coalesce("file_name", name)
    kind = F.upper(F.substring_index("file_role", "_", -1))
    told = F.concat(F.lit("Error processing "), kind, F.lit(" VCF for "), F.col("aliquot_id"), F.lit(": "), bad)
    files = roles.select("analysis_id", F.concat("analysis_id", F.lit("/"), name).alias("filepath"), "file_role", told.alias("told")) \
        .groupBy("analysis_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("told").isNull(), F.struct("filepath", F.col("file_role").alias("filetype")))))
        .alias("analysis_files"), F.sort_array(F.collect_list("told")).alias("errors"))
    j = (p.join(pa, "analysis_id", "left").join(hpo, "p_sequencing_id", "left")
         .join(onset, "p_sequencing_id", "left").join(files, "analysis_id", "left"))
    doc = F.struct(
        F.lit("1.0.0").alias("schema_version"),
        F.struct(F.col("p_sequencing_id").alias("externalid"), api_sex(F.col("gender")).alias("sex"),
                 F.coalesce("maternal_affected", F.lit(False)).alias("maternal_affected"),
                 F.coalesce("paternal_affected", F.lit(False)).alias("paternal_affected"),
                 F.lit("").alias("label"), F.col("analysis_id").alias("cohort")).alias("patient_details"),
        F.coalesce("hpo", F.array().cast("array<string>")).alias("phenotype_hpo_code_list"),
        onset_or_default(F.col("onset")).alias("phenotype_onset_hpo_code"),
        F.struct(F.lit(DOWNLOAD_SOURCE).alias("download_source"), F.struct(F.lit(bucket).alias("s3_bucket_name")).alias("details"))
        .alias("download_specifications"),
        F.coalesce("analysis_files", F.array()).alias("analysis_files"))
    error = F.when(F.size("errors") > 0, F.concat(F.lit("Failed to copy VCFs for analysis "), F.col("analysis_id"), F.lit(": "), F.array_join("errors", "; ")))
    return j.select("analysis_id", F.when(error.isNull(), doc).alias("request"),
                    F.when(error.isNull(), F.to_json(doc)).alias("document"), error.alias("error"))


def name_parts(name: Column) -> tuple[Column, Column]:
    """(aliquot, analysis) parsed from a ``"{aliquot} - {analysis}"`` sample name."""
    return name_aliquot(name), name_analysis(name)


# SURVEY §2.B names
file_role = file_roles
recode_sex = api_sex
pedigree_document = pedigree_documents
case_request = case_requests
phenotype_request = phenotype_requests
