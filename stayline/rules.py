"""The rules the models encode, in one place.

--- fixed values (must equal the reference's for the same answers) ---------
"""

INPATIENT_CLASS = "inpatient"          # encounters that are index stays / readmissions
HOSPICE_CLASS = "hospice"              # discharge destination that excludes an episode
HOSPICE_WINDOW_DAYS = 1                # hospice start within [discharge, discharge + 1 day]
DEATH_AFTER_DISCHARGE_DAYS = 1         # died in episode: admit day <= death <= discharge day + 1
READMISSION_WINDOW_DAYS = 30           # label: next admission within 30 calendar days
HISTORY_WINDOW_DAYS = 365              # prior episodes within 365 calendar days
DISORDER_PATTERN = "%(disorder)"       # LIKE, case-sensitive suffix
CHEMOTHERAPY_PATTERN = "%chemotherapy%"  # ILIKE, case-insensitive
UNKNOWN_ZIP3 = "000"                   # unknown area, becomes NULL with geo_known FALSE
