"""Lists, tables and patterns that results depend on.

Everything here is data. It must stay equal to the site markup and to the
stored match, log and list files, so it is written out plainly and in order.
"""

# --- Fixed values: match table ------------------------------------------------

MATCH_COLUMNS = [
    ("match_id", "string"),
    ("league_division", "string"),
    ("round", "string"),
    ("date", "string"),
    ("kickoff_time", "string"),
    ("attendance", "int"),
    ("capacity", "int"),
    ("stadium", "string"),
    ("city", "string"),
    ("home_team", "string"),
    ("away_team", "string"),
    ("home_goals", "int"),
    ("away_goals", "int"),
    ("result", "string"),
    ("home_formation", "string"),
    ("away_formation", "string"),
    ("home_team_rating", "decimal(3,1)"),
    ("away_team_rating", "decimal(3,1)"),
    ("home_shots_total", "int"),
    ("away_shots_total", "int"),
    ("home_shots_on_target", "int"),
    ("away_shots_on_target", "int"),
    ("home_shots_off_target", "int"),
    ("away_shots_off_target", "int"),
    ("home_shots_inside_box", "int"),
    ("away_shots_inside_box", "int"),
    ("home_shots_outside_box", "int"),
    ("away_shots_outside_box", "int"),
    ("home_headed_goals", "int"),
    ("away_headed_goals", "int"),
    ("home_hit_woodwork", "int"),
    ("away_hit_woodwork", "int"),
    ("home_corners", "int"),
    ("away_corners", "int"),
    ("home_free_kicks", "int"),
    ("away_free_kicks", "int"),
    ("home_throw_ins", "int"),
    ("away_throw_ins", "int"),
    ("home_fouls_committed", "int"),
    ("away_fouls_committed", "int"),
    ("home_offsides", "int"),
    ("away_offsides", "int"),
    ("home_yellow_cards", "int"),
    ("away_yellow_cards", "int"),
    ("home_red_cards", "int"),
    ("away_red_cards", "int"),
    ("home_goalkeeper_saves", "int"),
    ("away_goalkeeper_saves", "int"),
    ("home_possession_pct", "int"),
    ("away_possession_pct", "int"),
    ("home_touches_opp_box", "int"),
    ("away_touches_opp_box", "int"),
    ("home_passes_pct", "int"),
    ("away_passes_pct", "int"),
    ("home_passes_successful", "int"),
    ("away_passes_successful", "int"),
    ("home_passes_total", "int"),
    ("away_passes_total", "int"),
    ("home_long_passes_pct", "int"),
    ("away_long_passes_pct", "int"),
    ("home_long_passes_successful", "int"),
    ("away_long_passes_successful", "int"),
    ("home_long_passes_total", "int"),
    ("away_long_passes_total", "int"),
    ("home_passes_final_third_pct", "int"),
    ("away_passes_final_third_pct", "int"),
    ("home_passes_final_third_successful", "int"),
    ("away_passes_final_third_successful", "int"),
    ("home_passes_final_third_total", "int"),
    ("away_passes_final_third_total", "int"),
    ("home_crosses_pct", "int"),
    ("away_crosses_pct", "int"),
    ("home_crosses_successful", "int"),
    ("away_crosses_successful", "int"),
    ("home_crosses_total", "int"),
    ("away_crosses_total", "int"),
    ("home_big_chances", "int"),
    ("away_big_chances", "int"),
    ("home_duels_won", "int"),
    ("away_duels_won", "int"),
    ("home_errors_leading_to_shot", "int"),
    ("away_errors_leading_to_shot", "int"),
    ("home_errors_leading_to_goal", "int"),
    ("away_errors_leading_to_goal", "int"),
    ("home_accurate_through_passes", "int"),
    ("away_accurate_through_passes", "int"),
    ("home_tackles_pct", "int"),
    ("away_tackles_pct", "int"),
    ("home_tackles_successful", "int"),
    ("away_tackles_successful", "int"),
    ("home_tackles_total", "int"),
    ("away_tackles_total", "int"),
    ("home_shots_blocked", "int"),
    ("away_shots_blocked", "int"),
    ("home_clearances", "int"),
    ("away_clearances", "int"),
    ("home_interceptions", "int"),
    ("away_interceptions", "int"),
    ("home_xg", "decimal(6,2)"),
    ("away_xg", "decimal(6,2)"),
    ("home_xgot", "decimal(6,2)"),
    ("away_xgot", "decimal(6,2)"),
    ("home_xa", "decimal(6,2)"),
    ("away_xa", "decimal(6,2)"),
    ("home_xgot_faced", "decimal(6,2)"),
    ("away_xgot_faced", "decimal(6,2)"),
    ("home_goals_prevented", "decimal(6,2)"),
    ("away_goals_prevented", "decimal(6,2)"),
]
# Those that a summary page gives.
SUMMARY_COLUMNS = [
    "league_division", "round", "date", "kickoff_time", "attendance", "capacity", "stadium", "city",
    "home_team", "away_team", "home_goals", "away_goals", "result",
]

# Parts of a "87% (541/623)" value, as column suffixes.
PCT_COUNT_PARTS = ["pct", "successful", "total"]

# --- Fixed values: statistics labels ------------------------------------------

# label on the page (lower case) -> statistic
STAT_LABELS = [
    ("total shots", "shots_total"),
    ("shots on goal", "shots_on_target"),
    ("shots on target", "shots_on_target"),
    ("shots off target", "shots_off_target"),
    ("blocked shots", "shots_blocked"),
    ("shots outside the box", "shots_outside_box"),
    ("shots inside the box", "shots_inside_box"),
    ("hit woodwork", "hit_woodwork"),
    ("hit the post", "hit_woodwork"),
    ("corner kicks", "corners"),
    ("corners", "corners"),
    ("free kicks", "free_kicks"),
    ("throw ins", "throw_ins"),
    ("fouls", "fouls_committed"),
    ("offsides", "offsides"),
    ("yellow cards", "yellow_cards"),
    ("red cards", "red_cards"),
    ("goalkeeper saves", "goalkeeper_saves"),
    ("goals prevented", "goals_prevented"),
    ("ball possession", "possession_pct"),
    ("touches in opposition box", "touches_opp_box"),
    ("passes in final third", "passes_final_third"),
    ("long passes", "long_passes"),
    ("passes", "passes"),
    ("accurate passes", "accurate_passes"),
    ("accurate through passes", "accurate_through_passes"),
    ("big chances", "big_chances"),
    ("headed goals", "headed_goals"),
    ("crosses", "crosses"),
    ("duels won", "duels_won"),
    ("errors leading to shot", "errors_leading_to_shot"),
    ("errors leading to goal", "errors_leading_to_goal"),
    ("tackles", "tackles"),
    ("clearances", "clearances"),
    ("interceptions", "interceptions"),
    ("expected goals (xg)", "xg"),
    ("expected goals", "xg"),
    ("xg", "xg"),
    ("xg on target (xgot)", "xgot"),
    ("xg on target", "xgot"),
    ("xgot faced", "xgot_faced"),
    ("expected assists (xa)", "xa"),
    ("expected assists", "xa"),
]
# Statistics shown as "87% (541/623)".
PCT_COUNT_STATS = ["passes", "long_passes", "passes_final_third", "tackles", "crosses"]
# Statistics that keep a sign and decimals.
SIGNED_STATS = ["goals_prevented", "xg", "xgot", "xgot_faced", "xa"]
# Statistics that read 0 when the page has no row for them.
CARD_STATS = ["yellow_cards", "red_cards"]

# --- Fixed values: log tables -------------------------------------------------

LOG_COLUMNS = [
    ("scraped_at", "timestamp_ntz"),
    ("url", "string"),
    ("success", "boolean"),
    ("reason", "string"),
    ("non_empty_fields", "int"),
    ("t_summary_s", "double"),
    ("sleep_after_summary_s", "double"),
    ("t_stats_s", "double"),
    ("sleep_after_stats_s", "double"),
    ("t_lineups_s", "double"),
    ("t_scrape_only_s", "double"),
    ("t_total_s", "double"),
    ("sleep_before_next_match_s", "double"),
    ("cumulative_total_s", "double"),
]
RETRY_COLUMNS = [
    ("file_name", "string"),
    ("fields_before", "int"),
    ("fields_after", "int"),
    ("row_updated", "boolean"),
    ("retry_trigger", "string"),
    ("data_csv_found", "boolean"),
]
RETRY_REASONS = ["no_lineups", "no_stats"]
RETRY_THRESHOLD = 30
ERROR_TEXT_LENGTH = 120

# --- Fixed values: names and seasons ------------------------------------------

DATA_SUFFIX = "_match_data.csv"
LOG_SUFFIX = "_scrape_log.csv"
SEASON_FIRST_MONTH = 7
MATCH_SEASON_FIRST_MONTH = 8
PREVIOUS_SEASON = "2024-2025"

# --- Fixed values: league catalog ---------------------------------------------

# key, file prefix, country path, competition path, kind of listing page
LEAGUES = [
    ("premier_league", "egypt_", "egypt", "premier-league", "archive"),
    ("egypt_cup", "egypt_", "egypt", "egypt-cup", "archive"),
    ("premier_league", "england_", "england", "premier-league", "archive"),
    ("ligue_1", "france_", "france", "ligue-1", "archive"),
    ("bundesliga", "germany_", "germany", "bundesliga", "archive"),
    ("serie_a", "italy_", "italy", "serie-a", "archive"),
    ("laliga", "spain_", "spain", "laliga", "archive"),
    ("eredivisie", "netherlands_", "netherlands", "eredivisie", "archive"),
    ("championship", "england_", "england", "championship", "archive"),
    ("ligue_2", "france_", "france", "ligue-2", "archive"),
    ("2_bundesliga", "germany_", "germany", "2-bundesliga", "archive"),
    ("serie_b", "italy_", "italy", "serie-b", "archive"),
    ("laliga2", "spain_", "spain", "laliga2", "archive"),
    ("eerste_divisie", "netherlands_", "netherlands", "eerste-divisie", "archive"),
    ("champions_league", "europe_", "europe", "champions-league", "archive"),
    ("europa_league", "europe_", "europe", "europa-league", "archive"),
    ("conference_league", "europe_", "europe", "conference-league", "archive"),
    ("nations_league", "europe_", "europe", "uefa-nations-league", "archive"),
    ("world_cup", "world_", "world", "world-cup", "results"),
    ("club_world_cup", "world_", "world", "fifa-club-world-cup", "archive"),
    ("copa_libertadores", "south_america_", "south-america", "copa-libertadores", "archive"),
    ("copa_sudamericana", "south_america_", "south-america", "copa-sudamericana", "archive"),
    ("liga_mx", "mexico_", "mexico", "liga-mx", "archive"),
    ("j1_league", "japan_", "japan", "j1-league", "archive"),
    ("j2_league", "japan_", "japan", "j2-league", "archive"),
    ("saudi_pro_league", "saudi_", "saudi-arabia", "saudi-professional-league", "archive"),
    ("super_lig", "turkey_", "turkey", "super-lig", "archive"),
    ("caf_champions_league", "africa_", "africa", "caf-champions-league", "archive"),
]

# --- Fixed values: patterns on page text --------------------------------------

ROUND_WORDS = ["Round", "Matchday", "GW", "Week", "Jornada", "Spieltag", "Giornata", "Journée"]
ROUND_SEPARATORS = "-–·|"
# Tested in this order; the first one contained in the text names the round.
KNOCKOUT_STAGES = [
    "1/16-finals", "1/8-finals", "quarter-finals", "semi-finals", "third place", "final",
]
# In a breadcrumb: a round with its number behind a separator, and a number at the end.
NUMBERED_ROUND_PATTERN = rf"(?iU)[{ROUND_SEPARATORS}]\s*(?:{'|'.join(ROUND_WORDS)})\s*(\d+)"
TRAILING_ROUND_PATTERN = r"(?U)\s+(\d+)$"
STAGE_SEPARATOR_PATTERN = r"(?U)\s*-\s*"
TITLE_TEAMS_PATTERN = r"(?iU)^(.+?)\s+v\s+(.+?)(?:\s+\d{2}/|\s*[-|]|\s*Lineups|\s*Stats)"
SCORE_NUMBER_PATTERN = r"(?U)\b(\d+)\b"
TITLE_SCORE_PATTERN = r"(?U)(\d+)\s*[:\-]\s*(\d+)"
# Behind a label such as Attendance.
LABELLED_NUMBER_PATTERN = r"[:\s]+(\d[\d\s,\.]*)"
VENUE_PATTERN = r"(?iU)(?:Venue|Stadium)[:\s]+([^(\n]+)\s*\(([^)]+)\)"
CLOCK_PATTERN = r"(?U)\d{1,2}:\d{2}"
PAGE_CLOCK_PATTERN = r"(?U)\b(\d{1,2}:\d{2})\b"
DATE_PATTERN = r"(\d{2}/\d{2}/\d{4}|[A-Za-z]+ \d{2}, \d{4})"
DATE_FORMATS = ["MMMM dd, yyyy", "dd/MM/yyyy"]
KICKOFF_TIME_PATTERN = r"^\s*(\d{1,2}):(\d{2})\s*([AaPp][Mm])?\s*$"
FORMATION_PATTERN = r"\b(\d\s*-\s*\d\s*-\s*\d(?:\s*-\s*\d)?)\b"
RATING_PATTERN = r"\b(\d+\.\d+)\b"
RATING_WORD_PATTERN = r"(?:rating|avg|average)[^\d]{0,20}(\d+\.\d+)"
RATING_RANGE_PATTERN = r"\b([5-9]\.\d)\b"

# --- Fixed values: page markup ------------------------------------------------

# Listing pages
MATCH_ROW_CLASS = "event__match"

# Summary page. A leading dot is a whole class name, otherwise a part of the class text.
BREADCRUMB_TEST_ID = "wcl-breadcrumbs"
KICKOFF_CLASSES = [".duelParticipant__startTime", ".event__time", ".match-time", "startTime", "kickoff"]
HOME_TEAM_CLASSES = [
    (".duelParticipant__home", ".participant__participantName"),
    (".home-team", ".team-name"),
    ("HomeTeam", "name"),
]
AWAY_TEAM_CLASSES = [
    (".duelParticipant__away", ".participant__participantName"),
    (".away-team", ".team-name"),
    ("AwayTeam", "name"),
]
SCORE_CLASSES = [".detailScore__wrapper", ".scoreboard", ".current-result", "scoreBox", "score-board"]
INFORMATION_TEST_ID = "wcl-summaryMatchInformation"
INFORMATION_LABEL_CLASS = "wcl-infoLabelWrapper"
INFORMATION_VALUE_CLASS = "wcl-infoValue"

# Statistics page
STAT_ROW_CLASS = "wcl-category_"
STAT_HOME_CLASS = "wcl-homeValue"
STAT_AWAY_CLASS = "wcl-awayValue"
STAT_LABEL_TEST_ID = "wcl-statistics-category"
STAT_LABEL_CLASS = "wcl-category_6"
# tag, part of the class text; the first one that any element of the page has is used
OTHER_STAT_ROWS = [
    ("div", "statRow"),
    ("div", "stat-row"),
    ("div", "statistic__row"),
    ("div", "statistics__item"),
    ("li", "stat"),
    ("tr", "stat"),
]

# Lineups page, in the order they are tried
FORMATION_CLASSES = ["formation", "Formation"]
FORMATION_ATTRIBUTE = "data-formation"
FORMATION_LAST_CLASS = ".lineup__formation"
RATING_CLASSES = ["rating", "teamRating", "team-rating", "averageRating", "average-rating"]
