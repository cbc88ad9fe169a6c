"""Witnesses for families and phenotype documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import pedigree as ped
from strandline.plans.registry import witness

FAM_P = ("p AS (SELECT family_id, sequencing_id AS p_seq, aliquot_id AS pa, father_aliquot_id AS pf, "
         "mother_aliquot_id AS pm FROM clinical WHERE is_proband AND family_id IS NOT NULL "
         "QUALIFY row_number() OVER (PARTITION BY family_id ORDER BY sequencing_id) = 1)")
ANA_P = ("p AS (SELECT analysis_id, sequencing_id AS p_seq, aliquot_id AS pa, father_aliquot_id AS pf, "
         "mother_aliquot_id AS pm FROM clinical WHERE is_proband "
         "QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY sequencing_id) = 1)")
SUPPORTED = ("s AS (SELECT c.*, p.p_seq, p.pa, p.pf, p.pm FROM clinical c JOIN p USING (family_id) "
             "WHERE (pf IS NOT NULL OR pm IS NOT NULL) AND (c.sequencing_id = p_seq OR "
             "(NOT c.is_proband AND (c.aliquot_id = pf OR c.aliquot_id = pm))))")
FILLED = "coalesce(length({c}), 0) > 0"


@witness("ped_split", """
SELECT family_id, count(*) AS n_members FROM clinical GROUP BY family_id
""")
def _(v):
    fam, solo = ped.split_families(v.clinical)
    solos = solo.agg(F.count("*").alias("n_members")).select(F.lit(None).cast("string").alias("family_id"),
                                                             "n_members").where("n_members > 0")
    return ped.family_sizes(fam).unionByName(solos)


@witness("ped_supported", f"""
WITH {FAM_P}, {SUPPORTED}
SELECT family_id, aliquot_id, sequencing_id FROM s
""")
def _(v):
    return ped.supported_families(v.clinical).select("family_id", "aliquot_id", "sequencing_id")


@witness("ped_dropped", f"""
WITH {FAM_P}
SELECT c.family_id, c.sequencing_id, c.aliquot_id FROM clinical c JOIN p USING (family_id)
WHERE NOT c.is_proband AND NOT (coalesce(c.aliquot_id = pf, false) OR coalesce(c.aliquot_id = pm, false))
  AND ({FILLED.format(c='c.father_aliquot_id')} OR {FILLED.format(c='c.mother_aliquot_id')})
""")
def _(v):
    return ped.dropped_members(v.clinical).select("family_id", "sequencing_id", "aliquot_id")


@witness("ped_solo_duo_trio", f"""
WITH f AS (SELECT analysis_id, bool_or(is_proband) AS hp,
                  bool_or(NOT is_proband AND ({FILLED.format(c='father_aliquot_id')} OR {FILLED.format(c='mother_aliquot_id')})) AS hs,
                  bool_or({FILLED.format(c='snv_url')} OR {FILLED.format(c='cnv_url')}) AS hv
           FROM clinical GROUP BY analysis_id), {ANA_P}
SELECT analysis_id FROM f
WHERE hp AND NOT hs AND hv AND analysis_id IN (SELECT analysis_id FROM p WHERE p_seq IN (SELECT sequencing_id FROM clinical_signs))
""")
def _(v):
    return ped.solo_duo_trio(v.clinical, v.clinical_signs)


@witness("ped_with_parent", """
SELECT analysis_id, sequencing_id FROM clinical
WHERE analysis_id IN (SELECT analysis_id FROM clinical WHERE father_aliquot_id IS NOT NULL OR mother_aliquot_id IS NOT NULL)
""")
def _(v):
    return ped.with_a_parent(v.clinical).select("analysis_id", "sequencing_id")


@witness("ped_relation", f"""
WITH {FAM_P}, {SUPPORTED}
SELECT family_id, aliquot_id,
       CASE WHEN aliquot_id = pf THEN 'father' WHEN aliquot_id = pm THEN 'mother' WHEN aliquot_id = pa THEN 'proband' END AS relation
FROM s
""")
def _(v):
    return ped.with_relation(ped.supported_families(v.clinical), strict=True).select(
        "family_id", "aliquot_id", "relation")


@witness("ped_file_role", f"""
WITH {ANA_P},
r AS (SELECT c.analysis_id, c.aliquot_id, c.snv_url, c.cnv_url,
             CASE WHEN c.is_proband THEN 'patient' WHEN coalesce(c.aliquot_id = p.pm, false) THEN 'maternal' ELSE 'paternal' END AS who
      FROM clinical c LEFT JOIN p USING (analysis_id))
SELECT analysis_id, aliquot_id, who || '_called_snv' AS file_role, snv_url AS url FROM r WHERE snv_url IS NOT NULL
UNION ALL
SELECT analysis_id, aliquot_id, who || '_called_cnv' AS file_role, cnv_url AS url FROM r WHERE cnv_url IS NOT NULL
""")
def _(v):
    return ped.file_roles(v.clinical)


@witness("ped_parental_affected", f"""
WITH {ANA_P}
SELECT p.analysis_id, p.p_seq AS sequencing_id,
       coalesce((SELECT bool_or(c.affected_status) FROM clinical c WHERE c.analysis_id = p.analysis_id AND c.aliquot_id = p.pm), false) AS maternal_affected,
       coalesce((SELECT bool_or(c.affected_status) FROM clinical c WHERE c.analysis_id = p.analysis_id AND c.aliquot_id = p.pf
                 AND NOT coalesce(c.aliquot_id = p.pm, false)), false) AS paternal_affected
FROM p
""")
def _(v):
    return ped.parental_affected(v.clinical)


@witness("ped_coerce_sex", """
WITH fa AS (SELECT DISTINCT analysis_id, father_aliquot_id AS aliquot_id FROM clinical WHERE father_aliquot_id IS NOT NULL),
mo AS (SELECT DISTINCT analysis_id, mother_aliquot_id AS aliquot_id FROM clinical WHERE mother_aliquot_id IS NOT NULL),
m AS (SELECT c.analysis_id, c.aliquot_id, c.gender,
             CASE c.gender WHEN 'Male' THEN 'MALE' WHEN 'Female' THEN 'FEMALE' WHEN 'unknown' THEN 'UNKNOWN_SEX'
                  WHEN 'other' THEN 'OTHER_SEX' END AS mapped,
             fa.aliquot_id IS NOT NULL AS is_f, mo.aliquot_id IS NOT NULL AS is_m
      FROM clinical c
      LEFT JOIN fa ON c.analysis_id = fa.analysis_id AND c.aliquot_id = fa.aliquot_id
      LEFT JOIN mo ON c.analysis_id = mo.analysis_id AND c.aliquot_id = mo.aliquot_id)
SELECT analysis_id, aliquot_id, gender,
       CASE WHEN mapped IS NULL OR mapped <> 'UNKNOWN_SEX' THEN mapped WHEN is_f THEN 'MALE' WHEN is_m THEN 'FEMALE'
            ELSE mapped END AS pedigree_sex
FROM m
""")
def _(v):
    return ped.coerce_parent_sex(v.clinical).select("analysis_id", "aliquot_id", "gender", "pedigree_sex")


@witness("ped_recode", """
SELECT sequencing_id,
       CASE lower(gender) WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' WHEN 'other' THEN 'M' WHEN 'unknown' THEN 'M' ELSE 'M' END AS api_sex,
       CASE WHEN affected_status THEN 'AFFECTED' WHEN NOT affected_status THEN 'UNAFFECTED' ELSE 'MISSING' END AS affected
FROM clinical
""")
def _(v):
    return v.clinical.select("sequencing_id", ped.api_sex(F.col("gender")).alias("api_sex"),
                             ped.recode_affected(ped.affected_code(F.col("affected_status"))).alias("affected"))


@witness("ped_sign_ids", """
SELECT c.sequencing_id, coalesce(s.n, 0) AS n_ids, s.ids AS hpo_ids
FROM clinical c LEFT JOIN (SELECT sequencing_id, count(*) AS n, array_to_string(list_sort(list(hpo_id)), ',') AS ids
                           FROM clinical_signs WHERE affected_status GROUP BY sequencing_id) s USING (sequencing_id)
""")
def _(v):
    s = ped.sign_ids(v.clinical_signs, affected_only=True)
    j = v.clinical.select("sequencing_id").join(s, "sequencing_id", "left")
    return j.select("sequencing_id",
                    F.when(F.col("hpo_ids").isNull(), F.lit(0)).otherwise(F.size("hpo_ids")).cast("bigint").alias("n_ids"),
                    F.array_join("hpo_ids", ",").alias("hpo_ids"))


_RANK = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(ped.ONSET_ORDER))


@witness("ped_earliest_onset", f"""
SELECT c.sequencing_id, coalesce(o.onset, 'HP:0003674') AS onset
FROM clinical c LEFT JOIN (
  SELECT sequencing_id, arg_min(age_at_onset, rk) AS onset
  FROM (SELECT sequencing_id, age_at_onset, CASE age_at_onset {_RANK} END AS rk FROM clinical_signs)
  WHERE rk IS NOT NULL GROUP BY sequencing_id) o USING (sequencing_id)
""")
def _(v):
    o = ped.earliest_onset(v.clinical_signs)
    return (v.clinical.select("sequencing_id").join(o, "sequencing_id", "left")
            .select("sequencing_id", ped.onset_or_default(F.col("onset")).alias("onset")))


_SEX = ("CASE {g} WHEN 'Male' THEN 'MALE' WHEN 'Female' THEN 'FEMALE' WHEN 'other' THEN 'OTHER_SEX' END")


@witness("ped_document", f"""
WITH per AS (SELECT c.analysis_id, c.aliquot_id, json_merge_patch('{{}}', json_object(
                 'familyId', c.analysis_id, 'individualId', c.aliquot_id, 'paternalId', c.father_aliquot_id, 'maternalId', c.mother_aliquot_id,
                 'sex', coalesce({_SEX.format(g='c.gender')},
                   CASE WHEN (c.analysis_id, c.aliquot_id) IN (SELECT (analysis_id, father_aliquot_id) FROM clinical WHERE father_aliquot_id IS NOT NULL) THEN 'MALE'
                        WHEN (c.analysis_id, c.aliquot_id) IN (SELECT (analysis_id, mother_aliquot_id) FROM clinical WHERE mother_aliquot_id IS NOT NULL) THEN 'FEMALE' END),
                 'affectedStatus', CASE WHEN c.affected_status THEN 'AFFECTED' WHEN NOT c.affected_status THEN 'UNAFFECTED' END)) AS j
             FROM clinical c),
m AS (SELECT analysis_id, count(*) AS n, list(j ORDER BY aliquot_id) AS persons FROM per GROUP BY analysis_id),
f AS (SELECT sequencing_id, list(json_object('type', json_object('id', hpo_id, 'label', 'Sign ' || hpo_id)) ORDER BY hpo_id) AS feats
      FROM clinical_signs WHERE affected_status GROUP BY sequencing_id)
SELECT p.analysis_id, p.aliquot_id, m.n AS n_persons, CAST(json_merge_patch('{{}}', json_object('id', p.analysis_id, 'proband', json_object(
         'subject', json_object('id', p.aliquot_id, 'sex', {_SEX.format(g='p.gender')}), 'phenotypicFeatures', f.feats),
         'pedigree', json_object('persons', m.persons))) AS VARCHAR) AS document
FROM clinical p JOIN m USING (analysis_id) LEFT JOIN f USING (sequencing_id) WHERE p.is_proband
""")
def _(v):
    signs = v.clinical_signs.withColumn("name", F.concat(F.lit("Sign "), F.col("hpo_id")))
    d = ped.pedigree_documents(v.clinical, signs)
    return d.select("analysis_id", "aliquot_id", F.size("family.pedigree.persons").cast("bigint").alias("n_persons"), "document")


_NAME = ("CASE WHEN is_proband THEN 'family' ELSE aliquot_id END || ' - ' || "
         "CASE WHEN family_id IS NULL THEN 'None' ELSE analysis_id END || "
         "CASE WHEN gender = 'other' THEN '_reset' ELSE '' END")


@witness("ped_name_parts", f"""
WITH n AS (SELECT sequencing_id, {_NAME} AS sample_name FROM clinical)
SELECT sequencing_id, sample_name,
       nullif(trim(split_part(sample_name, ' - ', 1)), 'family') AS aliquot_part,
       nullif(CASE WHEN contains(trim(split_part(sample_name, ' - ', 2)), '_')
                   THEN split_part(trim(split_part(sample_name, ' - ', 2)), '_', 1)
                   ELSE trim(split_part(sample_name, ' - ', 2)) END, 'None') AS analysis_part
FROM n
""")
def _(v):
    c = v.clinical
    name = F.concat(ped.sample_name(F.when(F.col("is_proband"), F.lit(ped.FAMILY_KEYWORD)).otherwise(F.col("aliquot_id")),
                                    F.when(F.col("family_id").isNotNull(), F.col("analysis_id"))),
                    F.when(F.col("gender") == "other", "_reset").otherwise(""))
    n = c.select("sequencing_id", name.alias("sample_name"))
    return n.select("sequencing_id", "sample_name", ped.name_aliquot(F.col("sample_name")).alias("aliquot_part"),
                    ped.name_analysis(F.col("sample_name")).alias("analysis_part"))


@witness("fn_human_size", """
WITH s AS (SELECT doc_id, CAST(n_chars AS DOUBLE) * 104729 / 1048576 AS a, CAST(doc_id AS DOUBLE) * 131072 / 1048576 AS b
           FROM documents)
SELECT doc_id,
       CASE WHEN a > 1000 THEN printf('%.2f', a / 1024) || ' GB' ELSE printf('%.2f', a) || ' MB' END AS size_a,
       CASE WHEN b > 1000 THEN printf('%.2f', b / 1024) || ' GB' ELSE printf('%.2f', b) || ' MB' END AS size_b
FROM s
""")
def _(v):
    from strandline.functions import human_size

    d = v.documents
    return d.select("doc_id", human_size(F.col("n_chars") * 104729).alias("size_a"),
                    human_size(F.col("doc_id") * 131072).alias("size_b"))


CASE_MEMBERS = (f"{FAM_P.replace('mother_aliquot_id AS pm FROM', 'mother_aliquot_id AS pm, analysis_id AS pan FROM')}, "
                f"{SUPPORTED}, "
                "fm AS (SELECT p.pan AS case_id, 'family' AS kind, s.sequencing_id, s.aliquot_id, "
                "CASE WHEN s.aliquot_id = s.pf THEN 'father' WHEN s.aliquot_id = s.pm THEN 'mother' "
                "WHEN s.aliquot_id = s.pa THEN 'proband' END AS relation, p.p_seq AS proband_seq "
                "FROM s JOIN p USING (family_id)), "
                "so AS (SELECT analysis_id AS case_id, 'solo' AS kind, sequencing_id, aliquot_id, 'proband' AS relation, "
                "sequencing_id AS proband_seq FROM clinical WHERE family_id IS NULL AND is_proband), "
                "m AS (SELECT *, aliquot_id || ' - ' || case_id AS sample_name FROM (SELECT * FROM fm UNION ALL SELECT * FROM so))")


# people's names, birth dates (some unknown) and file keys; one file in seven is not in the service's bucket
_BORN = "CASE WHEN CAST(aliquot_id AS INT) % 5 <> 0 THEN date_add(DATE '1960-01-01', CAST(CAST(aliquot_id AS INT) * 17 % 20000 AS INT)) END"


@witness("ped_case_request", f"""
WITH {CASE_MEMBERS},
x AS (SELECT m.*, c.affected_status, c.gender, 'Person ' || c.aliquot_id AS first_name,
             coalesce(CAST(CASE WHEN CAST(c.aliquot_id AS INT) % 5 <> 0 THEN
                      DATE '1960-01-01' + CAST(CAST(c.aliquot_id AS INT) * 17 % 20000 AS INT) END AS VARCHAR), 'None') AS dob,
             'prod/' || m.case_id || '/' || substr(c.snv_url, 14) AS key FROM m JOIN clinical c USING (sequencing_id)),
e AS (SELECT *, CASE WHEN key IS NULL THEN 'No VCF to attach for aliquot_id ' || aliquot_id
                     WHEN CAST(aliquot_id AS INT) % 7 = 0 THEN 'VCF not found: franklin/' || key END AS err FROM x),
g AS (SELECT case_id, kind, proband_seq, count(*) AS n_samples, (list(err ORDER BY sample_name) FILTER (WHERE err IS NOT NULL))[1] AS error,
             list(json_object('assay_id', 'assay-1', 'sample_data', json_object(
               'sample_name', sample_name, 'name_in_vcf', aliquot_id, 'aws_files', json_array(json_object('key', key, 'type', 'VCF_SHORT')),
               'tissue_type', 'Whole Blood', 'patient_details', json_object('name', first_name, 'dob', dob, 'sex', gender))) ORDER BY sample_name) AS an,
             list(json_object('sample_name', sample_name, 'family_relation', relation, 'is_affected', affected_status) ORDER BY sample_name) AS fs
      FROM e GROUP BY case_id, kind, proband_seq),
ph AS (SELECT sequencing_id AS proband_seq, list_sort(list(hpo_id)) AS ids FROM clinical_signs GROUP BY 1)
SELECT g.case_id, g.kind, g.n_samples, g.error, CAST(CASE WHEN g.error IS NOT NULL THEN NULL
  WHEN g.kind = 'family' THEN json_object(
    'upload_specs', json_object('source', 'AWS', 'details', json_object('bucket', 'franklin', 'root_folder', '/')), 'analyses', g.an,
    'family_analyses', json_array(json_object('case_name', 'family - ' || g.case_id, 'family_samples', g.fs, 'phenotypes', coalesce(ph.ids, []))),
    'family_analyses_creation_specs', json_object('create_family_single_analyses', 'true'))
  ELSE json_object('upload_specs', json_object('source', 'AWS', 'details', json_object('bucket', 'franklin', 'root_folder', '/')), 'analyses', g.an)
  END AS VARCHAR) AS document
FROM g LEFT JOIN ph USING (proband_seq)
""")
def _(v):
    c = v.clinical.withColumns({"first_name": F.concat(F.lit("Person "), F.col("aliquot_id")), "birth_date": F.expr(_BORN),
                                "vcf_key": F.expr("substr(snv_url, 14)")})
    files = c.where("vcf_key IS NOT NULL").select("sequencing_id", "vcf_key")
    listing = c.where("vcf_key IS NOT NULL AND CAST(aliquot_id AS INT) % 7 <> 0").select(
        F.concat(F.lit("prod/"), "analysis_id", F.lit("/"), "vcf_key").alias("object_key"))
    r = ped.case_requests(c, v.clinical_signs, files, listing, assay_id="assay-1")
    return r.select("case_id", "kind", F.size("samples").cast("bigint").alias("n_samples"), "error", "document")


# some URLs are lists as text, some are of another kind of store
_CNV = ("CASE WHEN CAST(aliquot_id AS INT) % 13 = 0 THEN replace(cnv_url, 's3a://', 'gs://') "
        "WHEN CAST(aliquot_id AS INT) % 11 = 0 THEN 'WrappedArray(' || cnv_url || ')' ELSE cnv_url END")


@witness("ped_phenotype_request", f"""
WITH f AS (SELECT analysis_id, bool_or(is_proband) AS hp,
                  bool_or(NOT is_proband AND ({FILLED.format(c='father_aliquot_id')} OR {FILLED.format(c='mother_aliquot_id')})) AS hs,
                  bool_or({FILLED.format(c='snv_url')} OR {FILLED.format(c='cnv_url')}) AS hv
           FROM clinical GROUP BY analysis_id), {ANA_P},
ok AS (SELECT analysis_id FROM f WHERE hp AND NOT hs AND hv
       AND analysis_id IN (SELECT analysis_id FROM p WHERE p_seq IN (SELECT sequencing_id FROM clinical_signs))),
pg AS (SELECT p.*, c.gender FROM p JOIN clinical c ON c.sequencing_id = p.p_seq WHERE p.analysis_id IN (SELECT analysis_id FROM ok)),
hpo AS (SELECT sequencing_id, list_sort(list(hpo_id)) AS ids FROM clinical_signs GROUP BY 1),
ons AS (SELECT sequencing_id, arg_min(age_at_onset, rk) AS onset
        FROM (SELECT sequencing_id, age_at_onset, CASE age_at_onset {_RANK} END AS rk FROM clinical_signs)
        WHERE rk IS NOT NULL GROUP BY sequencing_id),
u AS (SELECT c.analysis_id, c.aliquot_id, 'snv' AS kind, c.snv_url AS url, c.is_proband, p.pm FROM clinical c JOIN p USING (analysis_id)
      UNION ALL SELECT c.analysis_id, c.aliquot_id, 'cnv', {_CNV.replace('aliquot_id', 'c.aliquot_id').replace('cnv_url', 'c.cnv_url')}, c.is_proband, p.pm
      FROM clinical c JOIN p USING (analysis_id)),
w AS (SELECT analysis_id, analysis_id || '/' || replace(split_part(url, '/', -1), ')', '') AS fp,
             CASE WHEN is_proband THEN 'patient' WHEN coalesce(aliquot_id = pm, false) THEN 'maternal' ELSE 'paternal' END || '_called_' || kind AS ft,
             CASE WHEN starts_with(url, 'gs://') THEN 'Error processing ' || upper(kind) || ' VCF for ' || aliquot_id || ': Invalid S3 URL format: ' || url END AS bad
      FROM u WHERE url IS NOT NULL),
fl AS (SELECT analysis_id, list(json_object('filepath', fp, 'filetype', ft) ORDER BY fp, ft) AS files,
              string_agg(bad, '; ' ORDER BY bad) AS bad FROM w GROUP BY analysis_id)
SELECT pg.analysis_id, 'Failed to copy VCFs for analysis ' || pg.analysis_id || ': ' || fl.bad AS error,
       CAST(CASE WHEN fl.bad IS NULL THEN json_object('schema_version', '1.0.0', 'patient_details', json_object('externalid', pg.p_seq,
         'sex', CASE lower(pg.gender) WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' ELSE 'M' END,
         'maternal_affected', coalesce((SELECT bool_or(c.affected_status) FROM clinical c WHERE c.analysis_id = pg.analysis_id AND c.aliquot_id = pg.pm), false),
         'paternal_affected', coalesce((SELECT bool_or(c.affected_status) FROM clinical c WHERE c.analysis_id = pg.analysis_id AND c.aliquot_id = pg.pf
                                        AND NOT coalesce(c.aliquot_id = pg.pm, false)), false),
         'label', '', 'cohort', pg.analysis_id),
         'phenotype_hpo_code_list', coalesce(hpo.ids, []), 'phenotype_onset_hpo_code', coalesce(ons.onset, 'HP:0003674'),
         'download_specifications', json_object('download_source', 's3_minio', 'details', json_object('s3_bucket_name', 'phenovar-import')),
         'analysis_files', coalesce(fl.files, [])) END AS VARCHAR) AS document
FROM pg LEFT JOIN hpo ON hpo.sequencing_id = pg.p_seq LEFT JOIN ons ON ons.sequencing_id = pg.p_seq
LEFT JOIN fl ON fl.analysis_id = pg.analysis_id
""")
def _(v):
    r = ped.phenotype_requests(v.clinical.withColumn("cnv_url", F.expr(_CNV)), v.clinical_signs)
    return r.select("analysis_id", "error", "document")
