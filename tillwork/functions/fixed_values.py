"""Results depend on these exact texts."""

# Normalised country name -> standard name.
COUNTRY_NAMES = {
    "European Community": "European Community",
    "Unknown": "Unknown",
    "West Indies": "West Indies",
    "Eire": "Ireland",
    "Rsa": "Republic of South Africa",
    "Channel Islands": "Jersey",
}

# Standard name -> country whose facts stand in for it.
COUNTRY_PROXIES = {
    "European Community": "France",
    "Unknown": "United Kingdom",
    "West Indies": "Dominican Republic",
}

# The currency of the books.
BASE_CURRENCY = "GBP"

# Product names that survive the first naming pass.
PRODUCTS_TO_KEEP = [
    "DOTCOM_POSTAGE", "POSTAGE", "COLUMBIAN_CANDLE_ROUND",
    "METAL_SIGN_CUPCAKE_SINGLE_HOOK", "COLOURING_PENCILS_BROWN_TUBE",
    "WHITE_BAMBOO_RIBS_LAMPSHADE", "MODERN_CHRISTMAS_TREE_CANDLE",
    "FAIRY_CAKE_PLACEMATS", "FRENCH_LATTICE_CUSHION_COVER",
    "FRENCH_FLORAL_CUSHION_COVER", "CHARLIE_LOLA_RED_HOT_WATER_BOTTLE",
    "BLUE_FLOCK_GLASS_CANDLEHOLDER", "BROCANTE_SHELF_WITH_HOOKS",
    "BLACK_SILOUETTE_CANDLE_PLATE", "CHERRY_BLOSSOM_DECORATIVE_FLASK",
    "COLUMBIAN_CANDLE_RECTANGLE", "COLUMBIAN_CUBE_CANDLE",
    "BATHROOM_METAL_SIGN", "ACRYLIC_JEWEL_SNOWFLAKE_BLUE",
    "ACRYLIC_JEWEL_SNOWFLAKE_PINK", "EAU_DE_NILE_JEWELLED_PHOTOFRAME",
    "PAPER_LANTERN_9_POINT_SNOW_STAR", "HOME_SWEET_HOME_BLACKBOARD",
    "HEART_T_LIGHT_HOLDER", "FRENCH_PAISLEY_CUSHION_COVER",
    "FROSTED_WHITE_BASE", "GINGHAM_HEART_DECORATION",
    "RETRO_PLASTIC_POLKA_TRAY", "RETRO_PLASTIC_DAISY_TRAY",
    "RETRO_PLASTIC_70_S_TRAY", "PRINTING_SMUDGES_THROWN_AWAY",
    "PINK_JEWELLED_PHOTO_FRAME", "PINK_FLOWERS_RABBIT_EASTER",
    "PINK_FLOCK_GLASS_CANDLEHOLDER", "PINK_FAIRY_CAKE_CUSHION_COVER",
    "PINK_BUTTERFLY_CUSHION_COVER", "PASTEL_PINK_PHOTO_ALBUM",
    "PASTEL_BLUE_PHOTO_ALBUM", "RUSTY_THROW_AWAY",
    "ROUND_BLUE_CLOCK_WITH_SUCKER", "REVERSE_21_5_10_ADJUSTMENT",
    "SWEETHEART_WIRE_WALL_TIDY", "STORAGE_TIN_VINTAGE_LEAF",
    "SQUARE_CHERRY_BLOSSOM_CABINET", "SET_OF_4_FAIRY_CAKE_PLACEMATS",
    "SILVER_VANILLA_FLOWER_CANDLE_POT", "ROSE_DU_SUD_CUSHION_COVER",
    "WATERING_CAN_GREEN_DINOSAUR", "WATERING_CAN_PINK_BUNNY",
]

# Remarks typed into the name field, removed in the second naming pass.
PRODUCTS_TO_REMOVE = [
    "FBA", "SHOW", "20713", "21494", "22467", "22719", "DIRTY", "RUSTY",
    "SHORT", "17129C", "ADJUST", "DAMGES", "FAULTY", "MANUAL", "CRACKED",
    "DAGAMED", "POSTAGE", "REX_USE", "WET_CTN", "CARRIAGE", "CAT_BOWL",
    "DISCOUNT", "FOR_SHOW", "MISSINGS", "SHOWROOM", "BREAKAGES",
    "CANT_FIND", "SOLD_AS_C", "SOLD_AS_D", "AMAZON_FEE", "CAN_T_FIND",
    "DOTCOM_SET", "RUST_FIXED", "SALE_ERROR", "STOCK_TAKE", "THROW_AWAY",
    "WET_MOULDY", "WRONG_INVC", "21733_MIXED", "BAD_QUALITY",
    "CRUSHED_CTN", "DAMAGES_ETC", "DOTCOM_SETS", "DOTCOMSTOCK",
    "ENTRY_ERROR", "FOUND_AGAIN", "MICHEL_OOPS", "SOLD_AS_A_B",
    "SOLD_IN_SET", "TAIG_ADJUST", "WET_CARTONS", "WET_DAMAGES",
    "WET_ROTTING", "85123A_MIXED", "AMAZON_SALES", "BANK_CHARGES",
    "BROKEN_GLASS", "DOTCOM_EMAIL", "LABEL_MIX_UP", "PHIL_SAID_SO",
    "POOR_QUALITY", "SHOW_DISPLAY", "SHOW_SAMPLES", "SOLD_AS_GOLD",
    "WATER_DAMAGE", "AMAZON_ADJUST", "CAME_AS_GREEN", "CODING_MIX_UP",
    "DAMAGED_DIRTY", "DAMAGED_STOCK", "DOTCOM_ADJUST", "MIX_UP_WITH_C",
    "RE_ADJUSTMENT", "SOLD_AS_17003", "SOLD_AS_22467", "WEBSITE_FIXED",
    "WRONG_BARCODE", "12_S_SOLD_AS_1", "DAMAGES_DOTCOM",
    "DOTCOM_POSTAGE", "FOUND_IN_W_HSE", "INVCD_AS_84879",
    "INVOICE_506647", "WRONG_CTN_SIZE", "BARCODE_PROBLEM",
    "DAMAGES_DISPLAY", "DAMAGES_SAMPLES", "MIXED_WITH_BLUE",
    "MY_ERROR_CONNOR", "OOPS_ADJUSTMENT", "REVERSE_MISTAKE",
    "SAMPLES_DAMAGES", "TEMP_ADJUSTMENT", "AMAZON_SOLD_SETS",
    "INCORRECT_CREDIT", "MOULDY_UNSALEABLE", "RUSTY_CONNECTIONS",
    "RUSTY_THROWN_AWAY", "SOLD_INDIVIDUALLY", "THROWN_AWAY_RUSTY",
    "WRONGLY_SOLD_SETS", "AMAZON_SOLD_AS_SET",
]
