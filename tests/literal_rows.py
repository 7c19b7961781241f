"""Literal applications with the score and decision the rules give them."""

COLUMNS = (
    "application_id bigint, person_age int, person_income double, person_home_ownership string, "
    "person_emp_length double, loan_intent string, loan_grade string, loan_amnt double, loan_int_rate double, "
    "loan_percent_income double, cb_person_default_on_file string, cb_person_cred_hist_length int"
)

# Rows, then (score, decision, rule).
ROWS = [
    (1, 25, 50000.0, "RENT", 3.0, "PERSONAL", "B", 15000.0, 12.5, 0.30, "N", 5),
    (2, 30, 80000.0, "OWN", 8.0, "HOMEIMPROVEMENT", "A", 25000.0, 8.5, 0.25, "N", 10),
    (3, 22, 25000.0, "RENT", 1.0, "PERSONAL", "D", 8000.0, 18.5, 0.45, "Y", 1),
    (4, 35, 60000.0, "MORTGAGE", 5.0, "EDUCATION", "C", 20000.0, 14.2, 0.35, "N", 6),
    (5, 35, 120000.0, "OWN", 10.0, "HOMEIMPROVEMENT", "A", 35000.0, 7.5, 0.25, "N", 12),
    (6, 21, 28000.0, "RENT", 1.0, "PERSONAL", "E", 12000.0, 22.5, 0.50, "Y", 1),
    (7, 24, 45000.0, "RENT", 2.0, "EDUCATION", "C", 18000.0, 15.0, 0.35, "N", 3),
    (8, 40, 150000.0, "MORTGAGE", 15.0, "VENTURE", "B", 100000.0, 9.5, 0.40, "N", 18),
    (9, 35, 60000.0, "RENT", 5.0, "PERSONAL", "B", 15000.0, 12.5, 0.25, "N", 8),
]
EXPECTED = {
    1: (0.4, "MANUAL_REVIEW", None),
    2: (0.3, "MANUAL_REVIEW", None),
    3: (1.0, "AUTO_REJECT", "R5b"),
    4: (0.7, "MANUAL_REVIEW", None),
    5: (0.3, "MANUAL_REVIEW", None),
    6: (1.0, "AUTO_REJECT", "R5b"),
    7: (0.7, "MANUAL_REVIEW", None),
    8: (0.6, "MANUAL_REVIEW", None),
    9: (0.4, "MANUAL_REVIEW", None),
}
