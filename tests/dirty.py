"""Seeded sheets with the flaws of real ones: gaps, bad texts, repeats, blanks, drifted headers."""

import csv
import random
from pathlib import Path

from crewlens import vocabulary as V

COUNTRIES = ["France", "Luxembourg", "Germany", ""]
ENTITIES = ["Paris", "Luxembourg, Ville", "Munich", ""]
GROUPS = ["Congés", "Maladie", "Accident", ""]


def write(path: Path, header: list[str], rows: list[list[object]]) -> None:
    with path.open("w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows([["" if c is None else c for c in r] for r in rows])


def generate(folder: Path, employees: int = 120, seed: int = 7) -> Path:
    r = random.Random(seed)
    folder.mkdir(parents=True, exist_ok=True)
    ids = [f"E{i:04d}" for i in range(employees)]
    home = {e: (r.choice(COUNTRIES), r.choice(ENTITIES)) for e in ids}

    def maybe(value: object, share: float, other: object = None) -> object:
        return other if r.random() < share else value

    rows = []
    for year, month in [(2024, m) for m in range(1, 13)] + [(2025, m) for m in range(1, 13)]:
        for e in ids:
            if r.random() < 0.1:
                continue
            backup_only = r.random() < 0.1
            rows.append([
                None if backup_only else e, e if backup_only or r.random() < 0.5 else None,
                maybe(f"{year}-{month:02d}-01", 0.02, "soon"), home[e][0], "Group",
                maybe("Female" if int(e[1:]) % 2 else "Male", 0.05), "Permanent", home[e][1], "30-39",
                maybe(f"{2000 + int(e[1:]) % 26}-06-15 08:00:00", 0.05, "unknown"),
            ])
    rows.append([None, None, "2025-12-01", "France", "Group", "Female", "Permanent", "Paris", "30-39", None])
    rows.append([ids[0], None, "2025-12-01", "Germany", "Group", "Female", "Permanent", "Munich", "30-39", None])
    rows.append([ids[1], None, None, "France", "Group", "Female", "Permanent", "Paris", "50-59", "2001-01-01"])
    write(folder / "workforce.csv", [
        V.ID_PRIMARY, V.ID_PRIMARY, V.PERIOD, " " + V.COUNTRY_LABEL, V.COUNTRY_GROUP, V.GENDER_LABEL, V.CONTRACT_LABEL,
        V.ENTITY_LABEL, "Age\u00a0range", V.ENTRY_DATE_PREFIX + "_FIRM",
    ], rows)

    scores = ["4", " 3 ", "N/A", "4,5", "1.0f", "5", "2", None]
    write(folder / "performance_2023.csv", [V.REVIEW_COUNTRY_2023, V.REVIEW_ID, V.REVIEW_SCORE_2023], [
        [{5: "France", 60: "Luxembourg"}.get(i), maybe(e, 0.05), r.choice(scores)] for i, e in enumerate(ids)
    ])

    documents = ["Evaluation 2024", "Fiche responsabilités", "Autre", None]
    write(folder / "performance_2024.csv", [
        V.REVIEW_ID, V.REVIEW_YEAR, V.REVIEW_SCORE, V.REVIEW_COUNTRY, V.DOCUMENT_NAME, V.REVIEW_STATUS, V.DOCUMENT_STATUS,
    ], [
        [maybe(r.choice(ids), 0.03), "2024", r.choice(scores), maybe(r.choice(["France", "Luxembourg"]), 0.05),
         r.choice(documents), r.choice(["Terminé", "En cours", None]), r.choice(["Clos", "Ouvert", None])]
        for _ in range(employees * 3)
    ])
    write(folder / "performance_working.csv", [
        V.WORKING_ID, V.WORKING_DOCUMENT_STATUS, V.REVIEW_SCORE, V.WORKING_UNIT, V.WORKING_CONTRACT, V.WORKING_YEAR,
    ], [
        [maybe(f" {r.choice(ids)} ", 0.03), r.choice(["Document Terminé", "TERMINE", "En cours", None]), r.choice(scores),
         "Unité, centrale", "CDI", "2025"] for _ in range(employees * 2)
    ])
    write(folder / "absenteeism.csv", [
        V.EMPLOYEE_CODE, V.ABSENCE_DATE, V.CALENDAR_DAYS, V.WORKED_DAYS, V.WORKABLE_DAYS, V.ABSENCE_GROUP,
        V.ABSENCE_REASON, V.COMPANY, V.GENDER,
    ], [
        [maybe(ids[0] if r.random() < 0.3 else r.choice(ids), 0.02), maybe(f"2025-{r.randint(1, 12):02d}-10", 0.03, "10 mars"),
         "1", maybe(r.choice(["0.5", "1", "2.5"]), 0.05, "x"), "1", r.choice(GROUPS), "motif", "S1", "F"]
        for _ in range(employees * 8)
    ])
    write(folder / "training_records.csv", [
        V.EMPLOYEE_CODE, V.TRAINING_YEAR, V.TRAINING_HOURS, V.TRAINING_STATUS, V.TRAINING_ENTITY, V.CERTIFICATIONS,
        V.COURSES, V.SESSION,
    ], [
        [maybe(e, 0.02), r.choice(["2023", "2024", "2025", "n.a."]), r.choice(["7", "3.5", "0", "-2", "12", "bad", None]),
         r.choice(["Réalisé", "Réalisé", "réalisé ", "Annulé", None]), "Paris", r.choice(["Yes", "yes", "No", None]),
         maybe("Cours", 0.1), f"S{r.randint(0, 30)}"]
        for e in (r.choice(ids[: employees * 2 // 3]) for _ in range(employees * 4))
    ])
    dates = ["31/12/2024", "1/2/2024", "15/06/2025", "2023-05-04", "bad", None]
    write(folder / "training_quick.csv", [V.SURVEY_ID, V.SURVEY_DATE, V.SURVEY_RATING, V.QUICK_STATUS], [
        [r.choice(ids), r.choice(dates), r.choice(["5", "4", "3", "-", None]), r.choice(["Complétée", "Complétée", "Ouverte"])]
        for _ in range(300)
    ])
    questions = [q.replace(" ", "\u00a0", 1) if i % 2 else q for i, q in enumerate(V.IMPACT_QUESTIONS)]
    write(folder / "training_cold.csv", [V.SURVEY_ID, V.SURVEY_DATE, V.COLD_STATUS, *questions], [
        [r.choice(ids), r.choice(dates), r.choice(["Complétée", "Complétée", "Ouverte"]),
         *([None] * 5 if r.random() < 0.1 else [r.choice(["Oui", " oui, tout à fait", "Non", None]) for _ in range(5)])]
        for _ in range(300)
    ])
    write(folder / "finance_pl.csv", ["Libellé", "2022", "2023", "2024", "2025", "note"], [
        ["Net Banking Income (PNB)", 100.5, 110, 120, 130, "k"], [None, 1, 1, 1, 1, None],
        ["Rémunérations & charges", -50, -55, -60, -65, None], ["Formation (training costs)", -1, -2, -3, -4, None],
        ["Autre", 9, 9, 9, 9, None],
    ])
    write(folder / "finance_fte.csv", ["ETP", "a", "b", "c", "d", "e", "f", "g", "h"], [
        ["Titre", *[None] * 8], ["Total ETP", None, 10, None, 11, None, 12, None, 13],
        ["CDI", None, 8, None, 9, None, 10, None, 11], ["CDD", None, 2, None, 2, None, 2, None, 2], ["x", *[1] * 8],
    ])
    return folder
