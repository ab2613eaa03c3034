"""Canonical listing schema and the small dimensions around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

# The columns of a listing, in the order of every export.
_TEXT_BEFORE = (
    "referenznummer", "category_id", "nama_perusahaan", "titik_data_di_peta", "posisi_kota", "alamat_detail", "detail_deskripsi",
    "gaji", "persyaratan", "jenis_ausbildung", "beruf_typ", "deskripsi_perusahaan", "apa_yang_ditawarkan", "link_website_perusahaan",
    "link_website_perusahaan_resmi", "website_type", "alamat_email_bewerbung", "link_bewerbung", "link_bewerbung_externe", "link_bewerbung_efektif", "bewerbung_sumber",
    "kontak_penanggung_jawab", "dokumen_yang_harus_dipenuhi", "ba_job_url", "sumber_data", "ausbildung_de_url",
)
LISTING = StructType(
    [StructField(c, StringType()) for c in _TEXT_BEFORE]
    + [StructField("is_duplicate_of_arbeitsagentur", BooleanType()), StructField("duplicate_of_refnr", StringType())]
    + [StructField(c, IntegerType()) for c in ("kelengkapan_score", "tahun_mulai", "bulan_mulai")]
    + [StructField(c, StringType()) for c in ("tanggal_mulai", "scraped_at")]
)
LISTING_COLUMNS = tuple(LISTING.fieldNames())

# Fields that count for the completeness score.
SCORE_FIELDS = (
    "nama_perusahaan", "titik_data_di_peta", "posisi_kota", "alamat_detail", "detail_deskripsi", "gaji", "persyaratan", "jenis_ausbildung", "deskripsi_perusahaan",
    "apa_yang_ditawarkan", "link_website_perusahaan", "alamat_email_bewerbung", "link_bewerbung", "kontak_penanggung_jawab", "dokumen_yang_harus_dipenuhi",
)

# Job types in display order, and their labels.
JOB_TYPES = ("ae", "dpa", "si", "dv", "fi_other", "non_fi", "dual", "skip")
TARGET_TYPES = JOB_TYPES[:4]
JOB_TYPE_LABELS = {
    "ae": "Anwendungsentwicklung", "dpa": "Daten- und Prozessanalyse", "si": "Systemintegration", "dv": "Digitale Vernetzung", "fi_other": "Fachinformatiker lainnya",
    "non_fi": "Bukan Fachinformatiker", "dual": "Duales Studium", "skip": "Non-target",
}

# Priorities of categories; all others have 0.
CATEGORY_PRIORITY = {
    "fachinformatiker_ae_2026": 4, "ausbildung_de_ae": 3, "ausbildung_de_dpa": 3, "meine_ausbildung_ae": 3, "meine_ausbildung_dpa": 3, "ausbildung_nrw_ae": 3, "ausbildung_nrw_dpa": 3,
    "azubiyo_de_ae": 3, "azubiyo_de_dpa": 3, "stepstone_de_ae": 3, "stepstone_de_dpa": 3, "indeed_de_ae": 3, "indeed_de_dpa": 3, "ausbildungsstellen_ae": 3,
    "ausbildungsstellen_dpa": 3, "ausbildungsstellen_dv": 3, "ausbildungsstellen_si": 3, "meinestadt_ae": 3, "meinestadt_dpa": 3, "meinestadt_dv": 3, "meinestadt_si": 3,
    "backinjob_ae": 3, "backinjob_dpa": 3, "backinjob_dv": 3, "backinjob_si": 3, "karriere_sw_ae": 3, "azubi_de_fi": 3, "ausbildungsmarkt_fi": 3,
    "aubi_plus_fi": 3, "wir_sind_bund_fi": 3, "fachinformatiker_dpa": 2, "fachinformatiker_ae": 1,
}

# Job boards that aren't employers' sites, and marks of the public job portal.
PARTNER_DOMAINS = (
    "ausbildung.de", "aubi-plus.de", "azubi.de", "deinjob.de", "finest-jobs.com", "jobexport.de", "karriere-suedwestfalen.de", "netto-online.de", "stepstone.de", "studyflix.de",
    "trainee-gefluester.de", "yourfirm.de", "indeed.com", "xing.com", "linkedin.com",
)
PORTAL_MARKERS = ("arbeitsagentur.de", "jobboerse.de")
# Fixed value: address of a listing's page on the public portal.
DETAIL_URL = "https://www.arbeitsagentur.de/jobsuche/jobdetail/"

# Columns and headers of the workflow export.
EXPORT_COLUMNS = (
    ("referenznummer", "id_referensi"), ("category_id", "kategori"), ("nama_perusahaan", "nama_perusahaan"), ("posisi_kota", "kota"), ("alamat_detail", "alamat"), ("jenis_ausbildung", "jenis_ausbildung"),
    ("beruf_typ", "spesialisasi"), ("tahun_mulai", "tahun_mulai"), ("bulan_mulai", "bulan_mulai"), ("gaji", "gaji"), ("kelengkapan_score", "skor_kelengkapan"), ("website_type", "tipe_website"),
    ("alamat_email_bewerbung", "email_bewerbung"), ("link_bewerbung_efektif", "link_bewerbung"), ("cara_apply", "cara_apply"), ("kontak_penanggung_jawab", "kontak_hr"), ("ba_job_url", "link_arbeitsagentur"),
    ("ringkasan_1_baris", "ringkasan"), ("butuh_manual", "butuh_manual"), ("status_lamaran", "status_lamaran"), ("prioritas", "prioritas"), ("detail_deskripsi", "deskripsi"),
    ("persyaratan", "persyaratan"), ("scraped_at", "tanggal_scrape"),
)


def lookup(mapping: dict, key: Column, default: object) -> Column:
    """Value of a small fixed mapping; default where the key isn't in it."""
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.coalesce(table[key], F.lit(default))


def category_priority(category: Column, priorities: dict[str, int] | None = None) -> Column:
    """Priority of a category; an empty mapping means the default one."""
    return lookup(priorities or CATEGORY_PRIORITY, category, 0)


def conform(df: DataFrame) -> DataFrame:
    """The canonical columns, in order and with their types; those that are missing are blank, and blank replaces null text."""
    have = set(df.columns)
    out = []
    for f in LISTING:
        c = F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, StringType):
            c = F.coalesce(c, F.lit(""))
        elif isinstance(f.dataType, BooleanType):
            c = F.coalesce(c, F.lit(False))
        elif f.name == "kelengkapan_score":
            c = F.coalesce(c, F.lit(0))
        out.append(c.alias(f.name))
    return df.select(*out)
