"""Headers, labels and thresholds of the source sheets and of the result tables.

All of these are FIXED VALUES: the inputs are labelled with them and the results are
compared against them, so they are kept as they are written in the sheets.
"""

import math

# Name of the row ordinal that readers add
ROW = "_row"

# Workforce snapshots
ID_PRIMARY = "ID Employee"
ID_BACKUP = "ID Employee.1"
PERIOD = "PERIOD"
COUNTRY_LABEL = "COUNTRY_GROUP_LABEL_EN"
COUNTRY_GROUP = "COUNTRY_GROUP"
GENDER_LABEL = "SEXE_GROUP_LABEL_EN"
CONTRACT_LABEL = "CONTRACT_GROUP_LABEL_EN"
ENTITY_LABEL = "ENTITY_LABEL_LOCAL"
AGE_RANGE = "Age range"
ENTRY_DATE_PREFIX = "DATE_ENTRY"  # the header ends with the name of the employer
FEMALE = "Female"

# Performance reviews
REVIEW_ID = "IUG"
REVIEW_COUNTRY_2023 = "Pays"
REVIEW_SCORE_2023 = "Note"
REVIEW_YEAR = "Année"
REVIEW_SCORE = "Note de performance"
REVIEW_COUNTRY = "Country"
DOCUMENT_NAME = "Nom du document"
DOCUMENT_KINDS = ("evaluation", "responsabilit")
REVIEW_STATUS = "Statut"
DOCUMENT_STATUS = "Statut du document"
REVIEW_DONE = "Terminé"
REVIEW_DONE_STEM = "termin"
HIGH_PERFORMER_FROM = 4

# Performance working sheet: some headers start with a blank
WORKING_ID = " IUG"
WORKING_DOCUMENT_STATUS = " Statut du document"
WORKING_UNIT = " Libellé Organisation niveau 06"
WORKING_CONTRACT = "Type contrat"
WORKING_YEAR = " Année"

# Absence events
EMPLOYEE_CODE = "Employee Code"
ABSENCE_DATE = "Date Absence"
CALENDAR_DAYS = "Jour Calendaires Absence"
WORKED_DAYS = "Jours Ouvrés Absence"
WORKABLE_DAYS = "Jours Ouvrables Absence"
ABSENCE_DAYS_PREFERENCE = (WORKED_DAYS, WORKABLE_DAYS, CALENDAR_DAYS)
ABSENCE_GROUP = "Regroupement Jour Absences"
ABSENCE_REASON = "Motif Jour Absence"
COMPANY = "Société"
GENDER = "Genre"
UNKNOWN = "Unknown"

# Training
TRAINING_YEAR = "Year"
TRAINING_HOURS = "Total_Training_Hours"
TRAINING_STATUS = "Status"
TRAINING_DONE = "Réalisé"
TRAINING_ENTITY = "Entity"
CERTIFICATIONS = "Certifications"
CERTIFIED = "yes"
COURSES = "Attended_Courses"
SESSION = "Session_ID"
SURVEY_ID = "Matricule"
SURVEY_DATE = "Date"
SURVEY_RATING = "Note générale"
QUICK_STATUS = "Statut"
COLD_STATUS = "Status"
SURVEY_DONE = "Complétée"
POSITIVE_ANSWER = "oui"
IMPACT_QUESTIONS = (
    "Considérez-vous que cette formation vous a permis de prendre confiance en vous :",
    "Considérez-vous que cette formation vous a permis de faciliter votre quotidien :",
    "Considérez-vous que cette formation vous a permis d’améliorer la qualité ou l’efficacité de votre travail :",
    "Considérez-vous que cette formation vous a permis de vous perfectionner dans un domaine que vous connaissiez déjà :",
    "Considérez-vous que cette formation vous a permis de développer de nouvelles compétences :",
)

# Finance
FINANCE_YEARS = ("2022", "2023", "2024", "2025")
FTE_FIRST_ROW = 1
FTE_SEGMENTS = ("total", "permanent", "temporary")
PL_METRICS = {
    "Net Banking Income (PNB)": "nbi",
    "Rémunérations & charges": "personnel_cost",
    "Formation (training costs)": "training_cost",
}

# Bands, thresholds and the reference date
BAND_LABELS = ("0h", "0.1-7h", "7-20h", "20h+")
BAND_EDGES_KPI = (-0.1, 0.1, 7.0, 20.0, math.inf)
BAND_EDGES_SEGMENT = (-0.01, 0.0, 7.0, 20.0, math.inf)
REFERENCE_DATE = "2025-12-31"
DAYS_PER_YEAR = 365.25
RISK_TENURE_YEARS = 10
RISK_ABSENCE_DAYS = 15
RISK_LABELS = ("High Risk", "Normal")
INDEX_RANGE = (0.0, 3.0)
HISTOGRAM_BINS = 30
REPORT_YEAR = 2025
FIRST_YEAR = 2024
NOT_AVAILABLE = "n/a"

# KPI table: (key, label, digits, definition), in the order of the result
# {year} stands for the report year.
KPI_ROWS = (
    ("headcount", "Latest monthly headcount", 0, "Unique active employees in latest workforce snapshot"),
    ("female", "Female representation", 1, "Share of active workforce labeled Female in latest snapshot (%)"),
    ("completion", "2024 review completion rate", 1, "Share of employees with a completed 2024 performance review (%)"),
    ("score", "2024 average performance score", 2, "Mean available 2024 performance rating (1-5)"),
    ("hours", "{year} training hours", 1, "Total completed training hours in {year}"),
    ("satisfaction", "Training satisfaction", 2, "Average post-training rating across completed quick reviews (1-5)"),
    ("absence", "{year} absence days per active employee", 2, "Total {year} worked absence days divided by latest active headcount"),
    ("nbi", "{year} NBI per FTE", 2, "Net banking income divided by average FTE"),
)

# Spreadsheet cell texts that mean "no value"
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
