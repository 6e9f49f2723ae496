"""Curated vocabularies: defaults, and readers for files that people edit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.runtime import local

# Domains in the order that decides ties, with terms of title, abstract, keywords and MeSH.
DOMAINS = {
    "vector_borne": ("Vector-borne diseases", ["dengue", "malaria", "zika", "zika virus infection", "chikungunya", "chikungunya fever", "aedes", "mosquito", "mosquito control", "mosquito breeding", "vector control", "wolbachia", "scrub typhus", "bed-net", "anopheles"]),
    "sti": ("Sexually-transmitted infections", ["hiv", "hiv infections", "syphilis", "gonorrhoea", "gonorrhea", "neisseria gonorrhoeae", "chlamydia", "chlamydia infections", "hpv", "genital herpes", "pre-exposure prophylaxis", "partner notification", "condom use"]),
    "tb": ("Tuberculosis", ["tuberculosis", "latent tuberculosis", "tuberculosis pulmonary", "tuberculin", "tuberculin test", "isoniazid", "rifampin", "rifampicin", "bedaquiline", "sputum", "interferon-gamma release assay", "culture conversion"]),
    "rti": ("Respiratory-tract infections", ["influenza", "influenza human", "covid-19", "sars-cov-2", "respiratory syncytial virus", "pneumonia", "pneumonia ventilator-associated", "pertussis", "rsv", "bronchiolitis", "croup"]),
    "amr_hai": ("AMR and healthcare-associated infections", ["antimicrobial resistance", "antimicrobial stewardship", "antibiotic stewardship", "carbapenem", "carbapenemase", "carbapenemase-producing", "carbapenem-resistant enterobacteriaceae", "mrsa", "methicillin-resistant staphylococcus aureus", "multidrug-resistant", "cross infection", "hand hygiene", "drug resistance multiple bacterial", "ventilator-associated", "surgical-site infection", "central-line"]),
}

# Kinds of research and words that show them.
RESEARCH_TYPES = {
    "basic_research": ("Basic research", ["in vitro", "mouse model", "pathogenesis", "mechanism"]),
    "case_study": ("Case study", ["case report", "case series", "case study"]),
    "clinical_studies": ("Clinical studies", ["randomised trial", "randomized trial", "cohort study", "clinical trial", "case-control study"]),
    "detection": ("Detection", ["detection", "diagnostic", "assay", "multiplex swab", "screening"]),
    "disease_management": ("Disease management", ["management", "intensive care", "clinical outcomes"]),
    "entomology": ("Entomology", ["aedes", "mosquito", "larval", "breeding habitats", "entomology"]),
    "genomics": ("Genomics", ["whole genome sequencing", "whole-genome sequencing", "phylogenetic", "genomic", "sequencing"]),
    "immunology": ("Immunology", ["interferon", "seroconversion", "immune", "antibody", "immunology"]),
    "infection_prevention_control": ("Infection prevention and control", ["infection control", "hand hygiene", "infection bundles", "contact precautions"]),
    "modelling": ("Modelling", ["model", "modelling", "modelled", "forecast", "reproduction number"]),
    "outbreak_management": ("Outbreak management", ["outbreak", "outbreaks", "contact tracing", "disease outbreaks"]),
    "surveillance_epidemiology": ("Surveillance and epidemiology", ["surveillance", "epidemiology", "incidence", "prevalence", "risk factors", "time-series analysis"]),
    "transmission": ("Transmission", ["transmission", "spread", "household contact"]),
    "treatment": ("Treatment", ["treatment", "therapy", "antiretroviral", "regimen"]),
    "vaccine": ("Vaccine", ["vaccine", "vaccines", "vaccination", "vaccine effectiveness", "booster dose"]),
    "virology": ("Virology", ["virus", "viral", "virology", "viraemia"]),
}

# MeSH headings too general to name a theme.
STOPLIST = [
    "adolescent", "adult", "aged", "animals", "child", "child preschool", "cohort studies", "cross infection", "cross-sectional studies", "disease outbreaks", "female",
    "follow-up studies", "hospitals", "humans", "incidence", "infant", "infant newborn", "infection", "logistic models", "male", "middle aged", "mortality", "population surveillance",
    "pregnancy", "prevalence", "prospective studies", "retrospective studies", "risk assessment", "risk factors", "seasons", "singapore", "surveys and questionnaires", "time factors",
    "travel", "treatment outcome", "vaccines", "young adult",
]

# Screening rules in the order of reasons.
RULES = [
    {"rule_id": "EXC-TYP-01", "verdict": "excluded", "test": "type", "values": ["editorial", "comment", "news"]},
    {"rule_id": "EXC-TYP-03", "verdict": "excluded", "test": "language"},
    {"rule_id": "EXC-TYP-04", "verdict": "excluded", "test": "year"},
    {"rule_id": "EXC-GEO-01", "verdict": "excluded", "test": "no_place"},
    {"rule_id": "UNC-LEAD", "verdict": "uncertain", "test": "lead"},
    {"rule_id": "EXC-GEO-02", "verdict": "uncertain", "test": "only_office", "values": ["inc", "ltd", "limited", "gmbh", "corp", "pharmaceuticals?", "biologics", "branch"]},
    {"rule_id": "INC-GEO-02", "verdict": "uncertain", "test": "place_in_text"},
    {"rule_id": "UNC-LETTER", "verdict": "uncertain", "test": "type", "values": ["letter"]},
    {"rule_id": "EXC-TYP-02", "verdict": "uncertain", "test": "type", "values": ["case reports"]},
    {"rule_id": "EXC-GEN-03", "verdict": "uncertain", "test": "no_abstract"},
    {"rule_id": "UNC-DOMAIN", "verdict": "uncertain", "test": "no_domain"},
]

# Countries by the names affiliations use.
COUNTRIES = [
    ("singapore", "Singapore", "Southeast Asia", "SGP"), ("malaysia", "Malaysia", "Southeast Asia", "MYS"), ("thailand", "Thailand", "Southeast Asia", "THA"),
    ("indonesia", "Indonesia", "Southeast Asia", "IDN"), ("philippines", "Philippines", "Southeast Asia", "PHL"), ("viet nam", "Viet Nam", "Southeast Asia", "VNM"),
    ("vietnam", "Viet Nam", "Southeast Asia", "VNM"), ("china", "China", "East Asia", "CHN"), ("japan", "Japan", "East Asia", "JPN"), ("india", "India", "South Asia", "IND"),
    ("sri lanka", "Sri Lanka", "South Asia", "LKA"), ("bangladesh", "Bangladesh", "South Asia", "BGD"), ("nepal", "Nepal", "South Asia", "NPL"), ("uk", "United Kingdom", "Europe", "GBR"),
    ("united kingdom", "United Kingdom", "Europe", "GBR"), ("france", "France", "Europe", "FRA"), ("germany", "Germany", "Europe", "DEU"), ("switzerland", "Switzerland", "Europe", "CHE"),
    ("usa", "United States", "North America", "USA"), ("u s a", "United States", "North America", "USA"), ("united states", "United States", "North America", "USA"),
    ("canada", "Canada", "North America", "CAN"), ("brazil", "Brazil", "Latin America", "BRA"), ("peru", "Peru", "Latin America", "PER"), ("colombia", "Colombia", "Latin America", "COL"),
    ("kenya", "Kenya", "Africa", "KEN"), ("south africa", "South Africa", "Africa", "ZAF"), ("australia", "Australia", "Oceania", "AUS"),
]


# Institutions by label, with country, region, sector and the names affiliations use.
INSTITUTIONS = [
    ("Agency for Science, Technology and Research", "Singapore", "Southeast Asia", "government", ["agency for science technology and research", "a star", "genome institute of singapore", "bioinformatics institute"]),
    ("Changi General Hospital", "Singapore", "Southeast Asia", "hospital", ["changi general hospital"]),
    ("Communicable Diseases Agency", "Singapore", "Southeast Asia", "government", ["communicable diseases agency"]),
    ("Duke-NUS Medical School", "Singapore", "Southeast Asia", "university", ["duke nus medical school", "duke nus graduate medical school"]),
    ("KK Women's and Children's Hospital", "Singapore", "Southeast Asia", "hospital", ["kk women s and children s hospital", "kkh", "kandang kerbau hospital"]),
    ("Khoo Teck Puat Hospital", "Singapore", "Southeast Asia", "hospital", ["khoo teck puat hospital"]),
    ("Ministry of Health, Singapore", "Singapore", "Southeast Asia", "government", ["ministry of health singapore", "singapore ministry of health"]),
    ("Nanyang Technological University", "Singapore", "Southeast Asia", "university", ["nanyang technological university", "lee kong chian school of medicine", "ntu singapore"]),
    ("National Centre for Infectious Diseases", "Singapore", "Southeast Asia", "hospital", ["national centre for infectious diseases", "national center for infectious diseases", "ncid"]),
    ("National Environment Agency", "Singapore", "Southeast Asia", "government", ["national environment agency", "environmental health institute"]),
    ("National Public Health Laboratory", "Singapore", "Southeast Asia", "government", ["national public health laboratory"]),
    ("National Skin Centre", "Singapore", "Southeast Asia", "hospital", ["national skin centre", "department of sexually transmitted infections control", "dsc clinic"]),
    ("National University Hospital", "Singapore", "Southeast Asia", "hospital", ["national university hospital singapore", "national university hospital"]),
    ("National University of Singapore", "Singapore", "Southeast Asia", "university", ["national university of singapore", "saw swee hock school of public health", "yong loo lin school of medicine"]),
    ("Ng Teng Fong General Hospital", "Singapore", "Southeast Asia", "hospital", ["ng teng fong general hospital"]),
    ("Sengkang General Hospital", "Singapore", "Southeast Asia", "hospital", ["sengkang general hospital"]),
    ("Singapore General Hospital", "Singapore", "Southeast Asia", "hospital", ["singapore general hospital"]),
    ("Tan Tock Seng Hospital", "Singapore", "Southeast Asia", "hospital", ["tan tock seng hospital", "communicable disease centre"]),
    ("Temasek Life Sciences Laboratory", "Singapore", "Southeast Asia", "research_institute", ["temasek life sciences laboratory"]),
    ("University of Malaya", "Malaysia", "Southeast Asia", "university", ["university of malaya", "universiti malaya"]),
    ("Mahidol University", "Thailand", "Southeast Asia", "university", ["mahidol university"]),
    ("London School of Hygiene and Tropical Medicine", "United Kingdom", "Europe", "university", ["london school of hygiene and tropical medicine", "lshtm"]),
    ("University of Oxford", "United Kingdom", "Europe", "university", ["university of oxford", "oxford university"]),
    ("University of Hong Kong", "China", "East Asia", "university", ["university of hong kong"]),
]


def institutions(spark: SparkSession) -> DataFrame:
    """(alias, label, country, region, sector) of the institutions of the library; a run's own list replaces it."""
    rows = [(a, label, country, region, sector) for label, country, region, sector, names in INSTITUTIONS for a in names]
    return local(spark, rows, "alias string, label string, country string, region string, sector string")


def countries(spark: SparkSession) -> DataFrame:
    """(alias, country, region, iso3) of the countries of the library."""
    return local(spark, COUNTRIES, "alias string, country string, region string, iso3 string")


def _labels(spark: SparkSession, source: dict[str, tuple[str, list[str]]]) -> DataFrame:
    rows = [(i, k, label, t) for i, (k, (label, ts)) in enumerate(source.items()) for t in ts]
    return local(spark, rows, "pos int, label_id string, label string, term string")


def domains(spark: SparkSession) -> DataFrame:
    """(pos, label_id, label, term) of the five domains."""
    return _labels(spark, DOMAINS)


def research_types(spark: SparkSession) -> DataFrame:
    return _labels(spark, RESEARCH_TYPES)


def stoplist(spark: SparkSession) -> DataFrame:
    return local(spark, [(t,) for t in STOPLIST], "term string")


def json_block(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the JSON array in the first fenced `json` block of a markdown file; an error if there is none or it can't be read."""
    text = spark.read.text(path, wholetext=True).first()
    block = None
    if text is not None:
        start = text[0].find("```json")
        end = text[0].find("```", start + 7)
        block = text[0][start + 7 : end] if 0 <= start < end else None
    if block is None:
        raise ValueError(f"no json block in {path}")
    df = spark.createDataFrame([(block,)], "t string").select(F.from_json("t", f"array<struct<{schema}>>", {"mode": "FAILFAST"}).alias("a"))
    return df.select(F.explode("a").alias("r")).select("r.*")


def csv_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with header, all columns text unless `schema` says otherwise; a file with a header only is an empty table."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


RULE_SCHEMA = "rule_id:string,verdict:string,test:string,values:array<string>"


def rules(spark: SparkSession, path: str, most: int = 10_000) -> list[dict]:
    """Screening rules from the JSON block of a markdown file; they become expressions, so their number is checked."""
    rows = json_block(spark, path, RULE_SCHEMA).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path}: {most} rules at most")
    return [r.asDict() for r in rows]
