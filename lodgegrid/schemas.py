"""Fixed column lists and the schemas built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# The conformed listing columns, in table order. The last four are
# added while loading.
LISTING_COLUMNS = """
id listing_url scrape_id last_scraped name description neighborhood_overview picture_url
host_id host_url host_name host_since host_location host_about host_response_time
host_response_rate host_acceptance_rate host_is_superhost host_thumbnail_url host_picture_url
host_neighbourhood host_listings_count host_total_listings_count host_verifications
host_has_profile_pic host_identity_verified neighbourhood neighbourhood_cleansed
neighbourhood_group_cleansed latitude longitude property_type room_type accommodates
bathrooms bathrooms_text bedrooms beds amenities price minimum_nights maximum_nights
minimum_minimum_nights maximum_minimum_nights minimum_maximum_nights maximum_maximum_nights
minimum_nights_avg_ntm maximum_nights_avg_ntm calendar_updated has_availability
availability_30 availability_60 availability_90 availability_365 calendar_last_scraped
number_of_reviews number_of_reviews_ltm number_of_reviews_l30d first_review last_review
review_scores_rating review_scores_accuracy review_scores_cleanliness review_scores_checkin
review_scores_communication review_scores_location review_scores_value license
instant_bookable calculated_host_listings_count calculated_host_listings_count_entire_homes
calculated_host_listings_count_private_rooms calculated_host_listings_count_shared_rooms
reviews_per_month month year_month year host_neighbourhood_cleansed
""".split()

# Columns a month's file does not deliver usably; they load as "".
BLANK_COLUMNS_BY_MONTH = {
    202005: ["bathrooms_text", "number_of_reviews_l30d"],
    202006: ["bathrooms_text", "number_of_reviews_l30d"],
    202007: [
        "bathrooms_text", "bedrooms", "beds", "amenities",
        "minimum_nights", "maximum_nights", "number_of_reviews_l30d",
    ],
}

# Strings the CSV loader treats as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Month names as the month column holds them.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# The census count table has one code column and these topics, each
# as male, female and persons (suffix M, F, P).
CENSUS_TOPICS = """
Tot_P
Age_0_4_yr Age_5_14_yr Age_15_19_yr Age_20_24_yr Age_25_34_yr Age_35_44_yr
Age_45_54_yr Age_55_64_yr Age_65_74_yr Age_75_84_yr Age_85ov
Counted_Census_Night_home Count_Census_Nt_Ewhere_Aust
Indigenous_psns_Aboriginal Indig_psns_Torres_Strait_Is Indig_Bth_Abor_Torres_St_Is
Indigenous_P_Tot Birthplace_Australia Birthplace_Elsewhere
Lang_spoken_home_Eng_only Lang_spoken_home_Oth_Lang Australian_citizen
Age_psns_att_educ_inst_0_4 Age_psns_att_educ_inst_5_14 Age_psns_att_edu_inst_15_19
Age_psns_att_edu_inst_20_24 Age_psns_att_edu_inst_25_ov
High_yr_schl_comp_Yr_12_eq High_yr_schl_comp_Yr_11_eq High_yr_schl_comp_Yr_10_eq
High_yr_schl_comp_Yr_9_eq High_yr_schl_comp_Yr_8_belw High_yr_schl_comp_D_n_g_sch
Count_psns_occ_priv_dwgs Count_Persons_other_dwgs
""".split()

# Medians and averages per area.
CENSUS_MEDIANS = """
Median_age_persons Median_mortgage_repay_monthly Median_tot_prsnl_inc_weekly
Median_rent_weekly Median_tot_fam_inc_weekly Average_num_psns_per_bedroom
Median_tot_hhd_inc_weekly Average_household_size
""".split()

CENSUS_CODE = "LGA_CODE_2016"
CENSUS_COUNT_COLUMNS = [CENSUS_CODE] + [f"{t}_{sex}" for t in CENSUS_TOPICS for sex in "MFP"]
CENSUS_MEDIAN_COLUMNS = [CENSUS_CODE] + CENSUS_MEDIANS
LGA_COLUMNS = ["neighbourhood_cleansed", "LGA_name", "CODE_2016"]

AGE_TOPICS = [t for t in CENSUS_TOPICS if t.startswith("Age_") and "_att_" not in t]
CENSUS_FACT_TOPICS = [
    t for t in CENSUS_TOPICS
    if t in AGE_TOPICS or t.startswith(("Birthplace_", "Lang_spoken_", "High_yr_"))
]
CENSUS_FACT_COUNTS = [f"{t}_{sex}" for t in CENSUS_FACT_TOPICS for sex in "MFP"]

HOST_KEY = [
    "host_id", "host_name", "host_is_superhost", "host_neighbourhood",
    "neighbourhood_cleansed", "host_neighbourhood_cleansed",
]
PROPERTY_KEY = ["property_type", "room_type", "has_availability"]
TIME_KEY = ["month", "year_month", "year"]

PRICE_TYPE = T.DecimalType(19, 2)

# Typed listing facts with their descriptive columns; every metric reads a subset.
LISTING_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in HOST_KEY + PROPERTY_KEY]
    + [
        T.StructField("month", T.StringType()),
        T.StructField("year_month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("accommodates", T.IntegerType()),
        T.StructField("availability_30", T.IntegerType()),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("review_scores_rating", T.DoubleType()),
        T.StructField("price", PRICE_TYPE),
    ]
)


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema: raw tables keep every value as it was delivered."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_LISTING_SCHEMA = text_schema(LISTING_COLUMNS)
CENSUS_COUNT_SCHEMA = text_schema(CENSUS_COUNT_COLUMNS)
CENSUS_MEDIAN_SCHEMA = text_schema(CENSUS_MEDIAN_COLUMNS)
LGA_SCHEMA = text_schema(LGA_COLUMNS)
DIM_LGA_SCHEMA = text_schema([c.lower() for c in LGA_COLUMNS])

CENSUS_FACT_SCHEMA = T.StructType(
    [T.StructField("abs_id", T.BinaryType()), T.StructField(CENSUS_CODE, T.StringType(), False)]
    + [T.StructField(c, T.LongType()) for c in CENSUS_FACT_COUNTS]
    + [T.StructField(c, T.DecimalType(12, 4)) for c in CENSUS_MEDIANS]
    + [T.StructField("lga_name", T.StringType())]
)
