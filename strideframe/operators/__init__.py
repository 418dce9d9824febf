from strideframe.operators.cleaning import align_time, clean_readings, mark_malformed, rejected_readings, settle_malformed, split_malformed
from strideframe.operators.features import engineer_features
from strideframe.operators.fusion import first_per_key, fuse_sensors, rename_axes
from strideframe.operators.learning import (
    SequenceCandidate,
    SequenceModel,
    StackedModel,
    build_base_pipeline,
    channel_vectors,
    feature_importance,
    fit_label_index,
    label_index_table,
    sequence_fit,
    split_tree,
    stack_fit,
    vector_stages,
    with_label_index,
)
from strideframe.operators.scoring import (
    accuracy,
    accuracy_by,
    accuracy_cross_check,
    classification_report,
    confusion_matrix,
    confusion_pct,
)
from strideframe.operators.series import HotGroups, first_n, hot_groups, number_rows
from strideframe.operators.splitting import (
    bernoulli_sample,
    hash_sample,
    shuffle_key,
    shuffled,
    split_rows,
    split_sizes,
    subject_split,
)
from strideframe.operators.summaries import (
    activity_counts,
    box_summary,
    category_names,
    corr_matrix,
    counts_by,
    describe_long,
    distinct_sketches,
    overview,
    subject_counts,
    united_distinct,
    with_activity_name,
)
from strideframe.operators.windows import (
    assign_windows,
    channel_windows,
    collect_windows,
    stack_channels,
    summarize_windows,
    tag_streams,
)

__all__ = [name for name in dir() if not name.startswith("_")]
