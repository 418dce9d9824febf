from strideframe.plans.activity import PipelineConfig, run_pipeline, run_sequence
from strideframe.plans.exploration import explore_device, explore_fused

__all__ = ["PipelineConfig", "explore_device", "explore_fused", "run_pipeline", "run_sequence"]
