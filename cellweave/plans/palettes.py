"""Colour tables of the published layers."""

# Fixed values: (value, r, g, b) entries of each visual table.
LAND_COVER = (
    (0, 98, 176, 204), (1, 72, 140, 95), (2, 152, 185, 130), (3, 160, 170, 195), (4, 215, 165, 95),
    (5, 205, 185, 130), (6, 180, 95, 85), (7, 175, 168, 158), (8, 185, 205, 225),
)
NDVI = (
    (-0.2, 139, 90, 43), (0, 210, 180, 140), (0.2, 255, 255, 153), (0.4, 173, 221, 142), (0.6, 120, 198, 121),
    (0.8, 49, 163, 84), (1, 0, 104, 55),
)
NIGHT_LIGHTS = (
    (0, 8, 8, 24), (5, 15, 25, 55), (10, 20, 45, 90), (25, 25, 70, 130), (50, 50, 120, 180), (75, 80, 180, 220),
    (100, 140, 220, 255), (150, 230, 245, 200), (200, 255, 255, 230), (300, 255, 255, 255),
)
ELEVATION_30M = ((0, 0, 0, 255), (250, 0, 255, 255), (500, 255, 255, 0), (750, 255, 0, 0), (1000, 255, 255, 255))
POPULATION = (
    (0, 255, 252, 240), (16, 255, 245, 220), (33, 255, 228, 181), (50, 255, 200, 124), (66, 255, 165, 0),
    (83, 255, 99, 71), (100, 178, 34, 34),
)
BUILT_UP = (
    (0, 255, 250, 240), (1000, 255, 230, 200), (2000, 250, 200, 160), (4000, 230, 150, 110), (6000, 190, 100, 80),
    (8000, 140, 60, 50),
)
URBANISATION = (
    (-200, 0, 0, 0), (10, 122, 182, 245), (11, 205, 245, 122), (12, 171, 205, 102), (13, 55, 86, 35),
    (21, 255, 255, 0), (22, 168, 112, 0), (23, 115, 38, 0), (30, 255, 0, 0),
)
ELEVATION_90M = (
    (-50, 0, 0, 180), (0, 0, 120, 255), (100, 0, 255, 255), (300, 255, 255, 0), (700, 255, 140, 0),
    (1200, 255, 255, 255),
)
HEIGHT_ABOVE_DRAINAGE = (
    (0, 255, 255, 255), (5, 255, 255, 153), (20, 255, 204, 102), (50, 255, 128, 0), (100, 204, 0, 0),
)
UPSTREAM_AREA = ((0, 255, 255, 255), (10, 173, 216, 230), (100, 0, 120, 255), (1000, 0, 0, 139))
FOREST_LOSS = ((0, 240, 240, 240), (1, 255, 0, 0))
TREE_COVER = ((0, 255, 255, 255), (50, 144, 238, 144), (100, 0, 100, 0))
WATER_TRANSITION = (
    (0, 255, 255, 255), (1, 0, 0, 255), (2, 34, 177, 76), (3, 209, 16, 45), (4, 153, 217, 234), (5, 181, 230, 29),
    (6, 230, 161, 170), (7, 255, 127, 39), (8, 255, 201, 14), (9, 127, 127, 127), (10, 195, 195, 195),
)
WATER_OCCURRENCE = ((0, 255, 255, 255), (50, 255, 187, 187), (100, 0, 0, 255))
WATER_SEASONALITY = ((0, 255, 255, 255), (6, 173, 216, 230), (12, 0, 0, 255))
FLOOD_DEPTH = (
    (0, 255, 255, 255), (0.5, 173, 216, 230), (1, 135, 206, 250), (2, 70, 130, 180), (3, 100, 149, 237),
    (4, 255, 215, 0), (5, 255, 165, 0), (6, 255, 140, 0), (7, 255, 99, 71), (8, 220, 20, 60), (10, 139, 0, 0),
)
PV_OUTPUT = (
    (3.0, 33, 102, 172), (3.5, 59, 130, 246), (3.75, 34, 197, 94), (4.0, 250, 204, 21), (4.25, 249, 115, 22),
    (4.5, 239, 68, 68), (5.0, 183, 28, 28),
)

# The value tables (value, code) of three class products. A value takes the code of the nearest entry.
URBANISATION_CODES = ((-200, 0), (10, 10), (11, 11), (12, 12), (13, 13), (21, 21), (22, 22), (23, 23), (30, 30))
FOREST_LOSS_CODES = ((0, 0), (1, 1))
WATER_TRANSITION_CODES = ((0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8), (9, 9), (10, 10))
