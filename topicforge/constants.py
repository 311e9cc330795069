"""Parameters whose values must equal the reference's for the same results."""

# --- fixed values (must equal the reference's) ---
PAGES_PER_ROOT = 2000          # per-root page quota of the category walk
MAX_DEPTH = 10                 # category levels 0..10 are walked
TEST_SHARE = 0.1               # train / test split 90 / 10
LEAD_SENTENCES = 5             # sentences kept for a page summary
WEB_LEAD_SENTENCES = 10        # sentences kept for a web page summary
TOP_K_TOPICS = 3               # topics reported per page
THRESHOLD = 0.5                # sigmoid(logit) > 0.5 is a positive prediction
BATCH_SIZE = 8                 # evaluation batch size (batch-mean figures)
MAX_INPUT_TOKENS = 512         # classifier input length
MAX_SUMMARY_TOKENS = 120       # summary output length
MAX_SUMMARY_LENGTH = 1024      # long-document filter on summary_length
DISTIL_TEMPERATURE = 4.0       # distillation temperature
DISTIL_ALPHA = 0.5             # weight of the hard-label loss
MIN_REPORTED_COUNT = 2         # topics are reported when found more than once
# --- end of fixed values ---
