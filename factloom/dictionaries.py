"""Dictionaries that map header texts to entities.

The defaults below are small. Larger ones are parameters: pass rows, DataFrames
or files with the same columns. All dictionaries are folded into one ``terms``
DataFrame with a row per text, so that classification needs a single look-up.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Fixed values: (code, kind, English name, French name, other spellings).
GEOGRAPHIES = [
    ("CA", "country", "Canada", "Canada", ["can", "total, canada", "total canada"]),
    ("total_provinces", "aggregate", "Total Provinces", "Total des provinces", ["all provinces", "provinces"]),
    ("total_territories", "aggregate", "Total Territories", "Total des territoires", ["all territories", "territories"]),
    ("BC", "province", "British Columbia", "Colombie-Britannique", ["b.c."]),
    ("AB", "province", "Alberta", "Alberta", ["alta."]),
    ("SK", "province", "Saskatchewan", "Saskatchewan", ["sask."]),
    ("MB", "province", "Manitoba", "Manitoba", ["man."]),
    ("ON", "province", "Ontario", "Ontario", ["ont."]),
    ("QC", "province", "Quebec", "Québec", ["que."]),
    ("NB", "province", "New Brunswick", "Nouveau-Brunswick", ["n.b."]),
    ("NS", "province", "Nova Scotia", "Nouvelle-Écosse", ["n.s."]),
    ("PE", "province", "Prince Edward Island", "Île-du-Prince-Édouard", ["p.e.i."]),
    ("NL", "province", "Newfoundland and Labrador", "Terre-Neuve-et-Labrador", ["n.l."]),
    ("YT", "territory", "Yukon", "Yukon", ["y.t."]),
    ("NT", "territory", "Northwest Territories", "Territoires du Nord-Ouest", ["n.w.t."]),
    ("NU", "territory", "Nunavut", "Nunavut", []),
    ("US", "country", "United States", "États-Unis", ["u.s."]),
    ("GB", "country", "United Kingdom", "Royaume-Uni", ["u.k."]),
    ("JP", "country", "Japan", "Japon", []),
    ("FR", "country", "France", "France", []),
    ("DE", "country", "Germany", "Allemagne", []),
    ("IT", "country", "Italy", "Italie", []),
]

# Fixed values: (key, spellings).
SCENARIOS = [
    ("actual", ["actual", "actuals", "réel", "historical", "historique", "observed", "outturn"]),
    ("projection", ["projection", "projected", "forecast", "prévision", "prévisions", "estimate", "plan", "planned"]),
    ("baseline", ["baseline", "reference case", "base case", "status quo"]),
    ("high", ["high", "high scenario", "upside", "upper bound"]),
    ("low", ["low", "low scenario", "downside", "lower bound"]),
    ("ongoing", ["ongoing", "continuing", "permanent", "recurring"]),
]

# Fixed values: (key, English name, French name, family, unit, additive, spellings).
METRICS = [
    ("gdp_real_growth", "Real GDP Growth", "Croissance du PIB réel", "macroeconomic", "percent", False,
     ["real gdp growth", "croissance du pib réel", "real gross domestic product growth", "gdp growth (real)"]),
    ("gdp_nominal", "Nominal GDP", "PIB nominal", "macroeconomic", "billions_cad", True,
     ["nominal gdp", "pib nominal", "nominal gross domestic product", "gdp (nominal)"]),
    ("gdp_nominal_growth", "Nominal GDP Growth", "Croissance du PIB nominal", "macroeconomic", "percent", False,
     ["nominal gdp growth", "croissance du pib nominal"]),
    ("gdp_real_level", "Real GDP", "PIB réel", "macroeconomic", "billions_cad", True,
     ["real gdp", "pib réel", "real gross domestic product"]),
    ("gdp_deflator", "GDP Inflation", "Inflation du PIB", "macroeconomic", "percent", False,
     ["gdp inflation", "inflation du pib", "gdp deflator", "déflateur du pib", "gdp price index"]),
    ("output_gap", "Output Gap", "Écart de production", "macroeconomic", "percent", False,
     ["output gap", "écart de production"]),
    ("us_gdp_real_growth", "US Real GDP Growth", "Croissance du PIB réel des É.-U.", "macroeconomic", "percent", False,
     ["us real gdp growth", "croissance du pib réel des é.-u.", "u.s. real gdp growth", "united states real gdp growth"]),
    ("cpi_inflation", "CPI Inflation", "Inflation selon l'IPC", "macroeconomic", "percent", False,
     ["cpi inflation", "inflation selon l'ipc", "consumer price index inflation", "inflation (cpi)", "inflation ipc"]),
    ("core_inflation", "Core Inflation", "Inflation fondamentale", "macroeconomic", "percent", False,
     ["core inflation", "inflation fondamentale", "underlying inflation"]),
    ("core_inflation_cpix", "Core Inflation (CPIX)", "Inflation fondamentale (IPCX)", "macroeconomic", "percent", False,
     ["core inflation (cpix)", "inflation fondamentale (ipcx)", "cpix", "ipcx"]),
    ("us_cpi_inflation", "US CPI Inflation", "Inflation selon l'IPC des É.-U.", "macroeconomic", "percent", False,
     ["us cpi inflation", "inflation selon l'ipc des é.-u.", "u.s. cpi inflation"]),
    ("us_gdp_inflation", "US GDP Inflation", "Inflation du PIB des É.-U.", "macroeconomic", "percent", False,
     ["us gdp inflation", "inflation du pib des é.-u.", "u.s. gdp inflation"]),
    ("unemployment_rate", "Unemployment Rate", "Taux de chômage", "labour", "percent", False,
     ["unemployment rate", "taux de chômage", "unemp. rate", "unemp rate"]),
    ("employment_growth", "Employment Growth", "Croissance de l'emploi", "labour", "percent", False,
     ["employment growth", "croissance de l'emploi", "emp. growth", "emp growth"]),
    ("employment", "Employment", "Emploi", "labour", "thousands", True,
     ["employment", "emploi", "number employed"]),
    ("labour_force", "Labour Force", "Population active", "labour", "thousands", True,
     ["labour force", "population active", "labor force", "labour force characteristics"]),
    ("participation_rate", "Participation Rate", "Taux d'activité", "labour", "percent", False,
     ["participation rate", "taux d'activité", "labour force participation rate"]),
    ("population", "Population", "Population", "labour", "thousands", True,
     ["population", "total population", "population totale"]),
    ("hours_worked", "Average Hours Worked", "Heures moyennes travaillées", "labour", "hours", False,
     ["average hours worked", "heures moyennes travaillées", "hours worked", "actual hours worked"]),
    ("hourly_earnings", "Average Hourly Earnings", "Rémunération horaire moyenne", "labour", "cad", False,
     ["average hourly earnings", "rémunération horaire moyenne", "hourly wage rate"]),
    ("interest_rate_3m", "3-Month Treasury Bill Rate", "Taux des bons du Trésor à 3 mois", "monetary", "percent", False,
     ["3-month treasury bill rate", "taux des bons du trésor à 3 mois", "3-month t-bill", "treasury bill rate"]),
    ("interest_rate_10y", "10-Year Government Bond Rate", "Taux des obligations d'État à 10 ans", "monetary", "percent", False,
     ["10-year government bond rate", "taux des obligations d'état à 10 ans", "10-year bond yield", "government of canada 10-year benchmark bond yield"]),
    ("exchange_rate_usdcad", "Exchange Rate (USD/CAD)", "Taux de change (USD/CAD)", "monetary", "cents_usd", False,
     ["exchange rate (usd/cad)", "taux de change (usd/cad)", "canada/u.s. exchange rate", "us exchange rate"]),
    ("policy_rate", "Policy Interest Rate", "Taux directeur", "monetary", "percent", False,
     ["policy interest rate", "taux directeur", "overnight rate", "bank of canada policy rate"]),
    ("exports", "Exports of Goods and Services", "Exportations de biens et services", "trade", "billions_cad", True,
     ["exports of goods and services", "exportations de biens et services", "exports", "exportations"]),
    ("imports", "Imports of Goods and Services", "Importations de biens et services", "trade", "billions_cad", True,
     ["imports of goods and services", "importations de biens et services", "imports", "importations"]),
    ("trade_balance", "Trade Balance", "Balance commerciale", "trade", "billions_cad", True,
     ["trade balance", "balance commerciale", "net exports", "exportations nettes"]),
    ("current_account_balance", "Current Account Balance", "Solde du compte courant", "trade", "billions_cad", True,
     ["current account balance", "solde du compte courant"]),
    ("wti_crude_oil", "Crude Oil Price (WTI)", "Prix du pétrole brut (WTI)", "trade", "usd_per_barrel", False,
     ["crude oil price (wti)", "prix du pétrole brut (wti)", "west texas intermediate", "wti", "crude oil"]),
    ("total", "Total", "Total", "fiscal", "billions_cad", True,
     ["total"]),
    ("budgetary_revenues", "Budgetary Revenues", "Revenus budgétaires", "fiscal", "billions_cad", True,
     ["budgetary revenues", "revenus budgétaires", "revenues", "revenus"]),
    ("personal_income_tax", "Personal Income Tax", "Impôt sur le revenu des particuliers", "fiscal", "billions_cad", True,
     ["personal income tax", "impôt sur le revenu des particuliers", "personal income tax revenues"]),
    ("corporate_income_tax", "Corporate Income Tax", "Impôt sur le revenu des sociétés", "fiscal", "billions_cad", True,
     ["corporate income tax", "impôt sur le revenu des sociétés", "corporate income tax revenues"]),
    ("gst_revenues", "GST Revenues", "Revenus de la TPS", "fiscal", "billions_cad", True,
     ["gst revenues", "revenus de la tps", "goods and services tax", "taxe sur les produits et services"]),
    ("ei_premium_revenues", "EI Premium Revenues", "Revenus des cotisations d'AE", "fiscal", "billions_cad", True,
     ["ei premium revenues", "revenus des cotisations d'ae", "employment insurance premium revenues"]),
    ("program_expenses", "Program Expenses", "Charges de programmes", "fiscal", "billions_cad", True,
     ["program expenses", "charges de programmes", "program spending", "expenses"]),
    ("public_debt_charges", "Public Debt Charges", "Frais de la dette publique", "fiscal", "billions_cad", True,
     ["public debt charges", "frais de la dette publique", "interest on debt"]),
    ("total_expenses", "Total Expenses", "Total des charges", "fiscal", "billions_cad", True,
     ["total expenses", "total des charges", "total spending"]),
    ("budgetary_balance", "Budgetary Balance", "Solde budgétaire", "fiscal", "billions_cad", True,
     ["budgetary balance", "solde budgétaire", "budget balance", "surplus/deficit"]),
    ("federal_debt", "Federal Debt", "Dette fédérale", "fiscal", "billions_cad", True,
     ["federal debt", "dette fédérale", "accumulated deficit", "déficit accumulé"]),
    ("debt_to_gdp", "Federal Debt-to-GDP Ratio", "Ratio de la dette fédérale au PIB", "fiscal", "percent", False,
     ["federal debt-to-gdp ratio", "ratio de la dette fédérale au pib", "debt-to-gdp", "debt to gdp ratio"]),
    ("net_debt", "Net Debt", "Dette nette", "fiscal", "billions_cad", True,
     ["net debt", "dette nette"]),
    ("expenditure", "Expenditure", "Dépenses", "expenditure", "cad", True,
     ["expenditure", "dépenses", "amount", "montant"]),
    ("budgetary_authority", "Budgetary Authorities", "Autorisations budgétaires", "expenditure", "cad", True,
     ["budgetary", "budgétaire", "budgetary authorities", "autorisations budgétaires"]),
    ("authorities_to_date", "Authorities To Date", "Autorisations à ce jour", "expenditure", "cad", True,
     ["authorities to date", "autorisations à ce jour"]),
    ("statutory_expenditure", "Statutory Expenditure", "Dépenses législatives", "expenditure", "cad", True,
     ["statutory expenditure", "dépenses législatives", "statutory", "législatif"]),
    ("voted_expenditure", "Voted Expenditure", "Dépenses votées", "expenditure", "cad", True,
     ["voted expenditure", "dépenses votées", "voted", "voté"]),
    ("transfer_payments", "Transfer Payments", "Paiements de transfert", "expenditure", "cad", True,
     ["transfer payments", "paiements de transfert", "transfers"]),
    ("consumer_confidence", "Consumer Confidence Index", "Indice de confiance des consommateurs", "survey", "index", False,
     ["consumer confidence index", "indice de confiance des consommateurs", "consumer confidence"]),
    ("business_confidence", "Business Confidence Index", "Indice de confiance des entreprises", "survey", "index", False,
     ["business confidence index", "indice de confiance des entreprises", "business outlook"]),
    ("housing_starts", "Housing Starts", "Mises en chantier", "survey", "thousands", True,
     ["housing starts", "mises en chantier"]),
    ("census_population", "Census Population", "Population recensée", "demographic", "persons", True,
     ["population", "pop", "population count", "total population"]),
    ("census_population_density", "Population Density", "Densité de population", "demographic", "per_sq_km", False,
     ["population density per square kilometre", "population density", "density"]),
    ("census_total_private_dwellings", "Total Private Dwellings", "Logements privés totaux", "demographic", "count", True,
     ["total private dwellings", "private dwellings", "dwellings"]),
    ("census_occupied_private_dwellings", "Private Dwellings Occupied by Usual Residents", "Logements privés occupés par des résidents habituels", "demographic", "count", True,
     ["private dwellings occupied by usual residents", "occupied private dwellings"]),
    ("census_land_area", "Land Area", "Superficie des terres", "demographic", "sq_km", True,
     ["land area in square kilometres", "land area", "area"]),
    ("census_population_change", "Population Percent Change", "Variation de population en pourcentage", "demographic", "percent", False,
     ["population, % change", "population percent change", "population % change"]),
]

# Fixed values: (type key, English name, [(value key, English, French)]).
ATTRIBUTES = [
    ("gender", "Gender", [("total", "Both sexes", "Les deux sexes"), ("men", "Men", "Hommes"), ("women", "Women", "Femmes")]),
    ("age_group", "Age Group", [("15_plus", "15 years and over", "15 ans et plus"), ("15_24", "15 to 24 years", "15 à 24 ans"), ("25_54", "25 to 54 years", "25 à 54 ans"), ("55_plus", "55 years and over", "55 ans et plus")]),
    ("sector", "Sector", [("public", "Public sector", "Secteur public"), ("private", "Private sector", "Secteur privé")]),
    ("worker_class", "Class of Worker", [("employee", "Employees", "Employés"), ("self_employed", "Self-employed", "Travailleurs autonomes")]),
    ("employment_type", "Employment Type", [("full_time", "Full-time", "Temps plein"), ("part_time", "Part-time", "Temps partiel")]),
    ("seasonal_adjustment", "Seasonal Adjustment", [("adjusted", "Seasonally adjusted", "Désaisonnalisées"), ("unadjusted", "Unadjusted", "Non désaisonnalisées")]),
]

# Fixed values: (id and code, English name, French name).
DEPARTMENTS = [
    ("fin", "Finance Canada", "Finances Canada"),
    ("statcan", "Statistics Canada", "Statistique Canada"),
    ("tbs-sct", "Treasury Board of Canada Secretariat", "Secrétariat du Conseil du Trésor du Canada"),
]

# Header names that carry no data (matched whole, ignoring case).
JUNK_HEADERS = [
    # structure metadata
    "@id", "@urn", "@lang", "@agencyid", "@version", "@package", "@class", "@assignmentstatus",
    "@position", "@maintainableparentid", "@maintainableparentversion", "conceptidentity",
    "localrepresentation", "attributerelationship", "enumeration", "textformat", "dimension",
    "primarymeasure", "annotationtitle", "annotationtype", "annotationtext", "annotation",
    "annotations", "ref", "name", "code",
    # cell formatting
    "@color", "@pattern", "@fontname", "@family", "@size", "@bold", "@italic", "@vertical",
    "@horizontal", "@wraptext", "@linestyle", "@weight", "@styleid", "@mergeacross", "@mergedown",
    "@index", "@autofitheight", "@autofitwidth", "border", "borders",
    # series housekeeping
    "@dguid", "dguid", "@vector_id", "@nb_decimal", "@terminated", "terminated", "@status_can",
    "status", "@security_level", "@symbol", "symbol", "coordinate", "decimals", "vector",
    "@code", "@iso-date",
]

# Columns holding observed values, and columns holding units.
VALUE_COLUMNS = ["@obs_value", "obs", "value"]
UNIT_COLUMNS = ["@uom", "uom", "uom_id", "@scalar_factor", "scalar_factor", "scalar_id"]
UNIT_PATTERN = r"^(?:per cent|percent|%|\$|millions? of dollars|billions?|thousands?|units?)$"

# Columns whose row values make up a metric label, and all dimension columns.
LABEL_COLUMNS = ["subject", "item", "subitem", "measure", "description", "details"]
DIMENSION_COLUMNS = [
    "category", "tax", "group", "measure", "details", "subject", "item", "subitem",
    "description", "organization", "vote", "vote number", "program",
]

TERM_SCHEMA = "term string, geo_code string, geo_type string, scenario_key string, metric_key string"
GEOGRAPHY_SCHEMA = "code string, geo_type string, name_en string, name_fr string, synonyms array<string>"
SCENARIO_SCHEMA = "scenario_key string, synonyms array<string>"
METRIC_SCHEMA = (
    "metric_key string, name_en string, name_fr string, family string, unit string, "
    "is_additive boolean, synonyms array<string>"
)
ATTRIBUTE_SCHEMA = "type_key string, type_name string, values array<struct<key:string,en:string,fr:string>>"


def junk_pattern(names: list[str]) -> str:
    """One alternation for the whole junk list, matched against a normalised header."""
    escaped = ["".join("\\" + c if c in ".-+*?()[]{}^$|\\" else c for c in n) for n in names]
    return r"^(?:" + "|".join(escaped) + r")$"


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Driver rows as a DataFrame of known size, so that Spark itself can decide to broadcast it."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return spark.createDataFrame(
        pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    )


@dataclass
class Dictionaries:
    """Terms for classification, and the entity tables that seed the dimensions."""

    terms: DataFrame
    geographies: DataFrame
    scenarios: DataFrame
    metrics: DataFrame
    attributes: DataFrame
    departments: DataFrame
    junk: str = field(default_factory=lambda: junk_pattern(JUNK_HEADERS))
    #: What rules and reviews decide for texts, see ``candidates.decisions_by_text``.
    decided: DataFrame | None = None

    def with_decisions(self, decided: DataFrame) -> "Dictionaries":
        return replace(self, decided=decided)

    @classmethod
    def default(cls, spark: SparkSession) -> "Dictionaries":
        return cls.from_rows(spark)

    @classmethod
    def from_rows(
        cls, spark: SparkSession, geographies=None, scenarios=None, metrics=None,
        attributes=None, junk: str | None = None,
    ) -> "Dictionaries":
        """Dictionaries given as Python rows; the first entry that claims a text wins."""
        geographies = GEOGRAPHIES if geographies is None else geographies
        scenarios = SCENARIOS if scenarios is None else scenarios
        metrics = METRICS if metrics is None else metrics
        attributes = ATTRIBUTES if attributes is None else attributes
        terms: dict[str, list] = {}

        def claim(text, slot, *values):
            entry = terms.setdefault(text.lower().strip(), [None] * 4)
            if text.strip() and entry[slot] is None:
                entry[slot:slot + len(values)] = values

        for code, kind, name_en, name_fr, synonyms in geographies:
            for text in [code, name_en, name_fr, *synonyms]:
                claim(text, 0, code, kind)
        for key, synonyms in scenarios:
            for text in synonyms:
                claim(text, 2, key)
        for key, *_, synonyms in metrics:
            for text in synonyms:
                claim(text, 3, key)
        made = cls(
            terms=local_table(spark, [(t, *v) for t, v in terms.items()], TERM_SCHEMA),
            geographies=local_table(spark, geographies, GEOGRAPHY_SCHEMA),
            scenarios=local_table(spark, scenarios, SCENARIO_SCHEMA),
            metrics=local_table(spark, metrics, METRIC_SCHEMA),
            attributes=local_table(
                spark, [(k, n, [dict(zip(("key", "en", "fr"), v)) for v in values]) for k, n, values in attributes],
                ATTRIBUTE_SCHEMA,
            ),
            departments=local_table(
                spark, DEPARTMENTS, "department_id string, department_name_en string, department_name_fr string"
            ),
        )
        if junk is not None:
            made.junk = junk
        return made

    @classmethod
    def from_tables(
        cls, spark: SparkSession, geographies: DataFrame, scenarios: DataFrame, metrics: DataFrame,
        attributes: DataFrame | None = None, junk: str | None = None,
    ) -> "Dictionaries":
        """Dictionaries given as DataFrames of any size, in the schemas above.

        ``position`` is an optional column that says which entry wins a text
        claimed twice; without it the smallest key wins. No broadcast is asked
        for: Spark decides by size.
        """
        made = cls.from_rows(spark, attributes=None if attributes is None else [])
        made.geographies, made.scenarios, made.metrics = geographies, scenarios, metrics
        if attributes is not None:
            made.attributes = attributes
        if junk is not None:
            made.junk = junk

        def spellings(df: DataFrame, key: str, texts) -> DataFrame:
            rank = F.col("position") if "position" in df.columns else F.col(key)
            value = F.struct(rank.alias("rank"), F.col(key).alias("key"))
            return (
                df.select(F.explode(texts).alias("term"), value.alias("entry"))
                .select(F.trim(F.lower("term")).alias("term"), "entry")
                .filter("term != ''")
                .groupBy("term").agg(F.min("entry").alias("entry"))
                .select("term", F.col("entry.key").alias(key))
            )

        no_texts = F.array().cast("array<string>")
        synonyms = F.coalesce("synonyms", no_texts)
        geo = spellings(geographies, "code", F.concat(F.array("code", "name_en", "name_fr"), synonyms))
        geo = geo.join(geographies.select("code", "geo_type"), "code", "left")
        made.terms = (
            geo.withColumnRenamed("code", "geo_code")
            .join(spellings(scenarios, "scenario_key", synonyms), "term", "full")
            .join(spellings(metrics, "metric_key", synonyms), "term", "full")
            .select("term", "geo_code", "geo_type", "scenario_key", "metric_key")
        )
        return made

    @classmethod
    def from_json(cls, spark: SparkSession, geographies: str, scenarios: str, metrics: str) -> "Dictionaries":
        """Dictionaries kept as newline-delimited JSON files."""
        read = lambda schema, path: spark.read.schema(schema + ", position long").json(path)
        return cls.from_tables(
            spark, read(GEOGRAPHY_SCHEMA, geographies), read(SCENARIO_SCHEMA, scenarios),
            read(METRIC_SCHEMA, metrics),
        )
