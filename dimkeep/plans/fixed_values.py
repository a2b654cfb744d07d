"""Fixed values of the school model: file names, column names and codes that the data uses."""

# Extract file -> staging table.
FILES = {
    "elev_basis.csv": "student_basis",
    "elev_historik.csv": "student_history",
    "elev_fravaer.csv": "student_absence",
    "elev_karakterer.csv": "student_grades",
}

# The files made of sections.
SECTIONED = {"elev_historik.csv", "elev_fravaer.csv", "elev_karakterer.csv"}

# Staged columns that a table does not keep.
DROPPED = {"student_grades": {"row_type"}}

# Source column -> staged column.
COLUMNS = {
    "student_basis": {
        "cprnr": "cpr_nr",
        "fornavn": "first_name",
        "efternavn": "last_name",
        "adresse1": "address_line1",
        "adresse2": "address_line2",
        "postnr": "postal_code",
        "bynavn": "city_name",
        "komkode": "municipality_code",
        "komnavn": "municipality_name",
        "betkomkode": "paying_mun_code",
        "betkomnavn": "paying_mun_name",
        "skoledistrikt": "school_district_code",
        "elevtrin": "student_level",
        "klassetrin": "class_level",
        "betegnelse": "class_label",
        "klassespor": "class_track",
        "klassetype": "class_type_code",
        "klassetype_tekst": "class_type_name",
        "elevtype": "student_type_code",
        "elevtype_tekst": "student_type_name",
        "fødselsdato": "birth_date",
        "køn": "gender",
        "statsborgerskab": "nationality_code",
        "statsborgerskab_tekst": "nationality_name",
        "fødeland": "birth_country_code",
        "fødeland_tekst": "birth_country_name",
        "modersmål": "mother_tongue_code",
        "modersmål_tekst": "mother_tongue_name",
        "skolekode": "school_code",
        "skolenavn": "school_name",
        "skoletype": "school_type_code",
        "skoletypebetegnelse": "school_type_name",
        "far_cprnr": "father_cpr",
        "far_fornavn": "father_first_name",
        "far_efternavn": "father_last_name",
        "far_fødeland_tekst": "father_birth_country",
        "far_statsborgerskab_tekst": "father_nationality",
        "far_myndighed_tekst": "father_custody",
        "mor_cprnr": "mother_cpr",
        "mor_fornavn": "mother_first_name",
        "mor_efternavn": "mother_last_name",
        "mor_fødeland_tekst": "mother_birth_country",
        "mor_statsborgerskab_tekst": "mother_nationality",
        "mor_myndighed_tekst": "mother_custody",
        "elev_id": "student_id",
        "uni_login": "uni_login",
        "tiltag_dansk_andet_sprog": "action_danish_second_lang",
        "tiltag_modtageklasse": "action_reception_class",
        "tiltag_specialundervisning": "action_special_education",
        "tiltag_suppl_dansk_andet_sprog": "action_supp_danish",
        "tiltag_juniormesterlaere": "action_junior_master",
        "tiltag_mellemformer": "action_intermediate",
        "hemmelig_adresse": "secret_address",
        "fototilladelse_tekst": "photo_permission",
        "trans_tilladelse_tekst": "transport_permission",
        "hovedskole_kode": "main_school_code",
        "hovedskole_navn": "main_school_name",
        "skoleejerforhold": "school_owner_type",
    },
    "student_history": {
        "row_type": "row_type",
        "Cprnr": "cpr_nr",
        "Skolekode": "school_code",
        "Skolenavn": "school_name",
        "Skoletype": "school_type_code",
        "Klassebetegnelse": "class_label",
        "Klassetype": "class_type_code",
        "Elevklassetrin": "student_level",
        "Stamklassetrin": "class_level",
        "Klassespor": "class_track",
        "Fradato": "valid_from",
        "Tildato": "valid_to",
        "Tiltagstype": "action_type_code",
        "Henvisningsaarsag": "referral_reason_code",
        "Timer": "hours",
        "TimerUdenForundervisning": "hours_outside",
        "Haendelsestype": "event_type_code",
        "Dato": "event_date",
        "Feltnavn": "field_name",
        "Feltvaerdi": "field_value",
        "Tilflyttetkommunekode": "moved_to_mun_code",
        "TilflyttetDato": "moved_date",
        "_extra_3": "school_code",
    },
    "student_absence": {
        "row_type": "row_type",
        "cprnr": "cpr_nr",
        "aarsag": "absence_reason",
        "dato": "absence_date",
        "lektionsnr": "lesson_number",
        "lektion": "half_day_part",
        "fagkode": "subject_code",
        "skolekode": "school_code",
        "trin": "class_level",
        "spor": "class_track",
    },
    "student_grades": {
        "row_type": "row_type",
        "Cprnr": "cpr_nr",
        "Fagkode": "subject_code",
        "Disciplin": "discipline_code",
        "Klassetrin": "class_level",
        "Skoleaar": "school_year_int",
        "FS10": "is_fs10",
        "SP1_Karakter": "grade_sp1",
        "SP2_Karakter": "grade_sp2",
        "SPS_Karakter": "grade_sp_final",
        "ARB1_Karakter": "grade_work1",
        "ARB2_Karakter": "grade_work2",
        "ARBS_Karakter": "grade_work_final",
        "PRV_Karakter": "grade_exam",
        "Skolekode": "school_code",
        "UVM_Disciplin": "uvm_discipline_code",
        "Prøvetype": "exam_type_code",
    },
}

# Row types of the history and absence extracts.
ENROLLMENT, ACTION, EVENT, FIELD, RELOCATION = 4, 5, 6, 7, 8
LESSON = 6
DAILY = (5, 7)

# Absence reasons that count.
REASONS = ("S", "L", "U", "F")

# Schools that are their own main school, and all known main schools.
OWN_MAIN_SCHOOLS = (280628, 821019, 821006)
MAIN_SCHOOLS = (280093, 280094, 280096, 280626, 280627, 280628, 821019, 821006)

# Known school districts, and the school whose students keep a previous main school.
DISTRICTS = (1, 11, 18, 20, 22, 23)
TRANSFER_SCHOOL = 280628

# Generated school type name; sentinel of the text-keyed exam type.
SCHOOL_TYPE_PREFIX = "Skoletype "
UNKNOWN_EXAM = "-1"
