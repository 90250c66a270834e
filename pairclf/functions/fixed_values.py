"""Fixed values. Results depend on these exact values and texts."""

# Training grid: iteration limits, step sizes, regularisation.
ITERATIONS = [10, 50, 100, 300]
STEP_SIZES = [1.0]
REG_PARAMS = [0.01]

# Convergence tolerance of the gradient descent.
TOLERANCE = 0.001

# Share of rows that go to training, in percent.
PAIR_TRAIN_PERCENT = 50
REST_TRAIN_PERCENT = 80
SECOND_SOURCE_TRAIN_PERCENT = 50
SWEEP_TRAIN_PERCENTS = [20, 50, 70, 90]

# Number of hash buckets of the split; a bucket is one percent.
BUCKETS = 100

# Label of all rows outside class1 in a one-against-the-rest task.
REST_LABEL = "All"

# Characters cut off the end of a file name when reading its label.
NAME_SUFFIX_LENGTH = 9

# Rows listed in the report of misclassified images, and its column name.
LISTED_IMAGES = 30
LISTED_COLUMN = "images non reconnus"

# Text formats.
TASK_KEY_FORMAT = "%s_vs._%s"
CURVE_NAME_FORMAT = "%s_Obs_%s_vs_%s.png"
WORD_TOTAL_FORMAT = "%s\t%d occurences"
MODEL_REPORT_FORMAT = (
    "|%s #%d\n"
    "|%s trained with (numIter: %s, stepSize = %s, regParam = %s)\n"
    "|%s has accuracy of %s (errors: %d / training error: %s) on test"
)
BEST_REPORT_FORMAT = (
    "|Model #%d is the best model\n"
    "|The best model was trained with (numIter: %s, stepSize = %s, regParam = %s)\n"
    "|The best model has accuracy of %s (errors: %d / training error: %s) on test"
)
