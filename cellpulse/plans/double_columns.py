"""Floating output columns per query (generated by tools/check_oracle.py --write-doubles)."""
DOUBLE_COLUMNS: dict[str, list[str]] = {
    'adhoc_fleet_snapshot': ['avg_predicted_soh', 'avg_remaining_cycles'],
    'adhoc_lot_risk': ['escalation_rate', 'early_degradation_rate', 'avg_final_soh'],
    'adhoc_station_anomaly': ['thermal_anomaly_rate', 'impedance_spike_rate', 'escalation_rate'],
    'adhoc_thermal_band': ['avg_capacity_fade_rate', 'avg_final_soh', 'thermal_anomaly_rate'],
    'adhoc_urgent_cells': ['failure_probability', 'predicted_soh', 'predicted_remaining_cycles'],
    'adhoc_usage_drivers': ['avg_capacity_fade_rate', 'avg_resistance_growth_rate', 'avg_last_soh', 'avg_failure_probability'],
    'anomaly_mix_by_lot': ['rate'],
    'backtest_baseline_metrics': ['precision', 'recall', 'f1', 'roc_auc'],
    'backtest_baseline_rows': ['value'],
    'batch_failure_rate': ['batch_failure_rate'],
    'battery_rollup': ['initial_capacity_ah', 'final_capacity_ah', 'capacity_loss_pct', 'capacity_cycle_corr', 'mean_discharge_temp_c', 'max_discharge_temp_c', 'max_charge_temp_c'],
    'battery_rollup_b': ['initial_capacity_ah', 'final_capacity_ah', 'capacity_loss_pct', 'max_discharge_temp_c'],
    'best_threshold': ['threshold', 'cost'],
    'bootstrap_effect': ['effect', 'lo', 'hi'],
    'calibration_table': ['mean_predicted_probability', 'observed_escalation_rate'],
    'case_study_cell': ['failure_probability', 'lot_mean_escalation', 'station_mean_escalation', 'lot_station_escalation'],
    'cell_event_lookup': [],
    'cell_features': ['final_soh', 'capacity_fade_rate', 'resistance_growth_rate', 'peak_temperature_max', 'mean_temperature_max', 'fast_charge_ratio', 'avg_depth_of_discharge', 'high_temp_exposure_hours', 'low_temp_exposure_hours', 'batch_failure_rate', 'station_anomaly_rate'],
    'cell_trajectory_50': ['discharge_capacity_ah', 'internal_resistance_mohm', 'temperature_max'],
    'class_balance': [],
    'classification_metrics': ['precision', 'recall', 'f1', 'roc_auc'],
    'clean_cycles': ['voltage_mean', 'voltage_min', 'voltage_max', 'current_mean', 'temperature_mean', 'temperature_max', 'discharge_capacity_ah', 'charge_capacity_ah', 'internal_resistance_mohm', 'energy_wh'],
    'clean_cycles_removed': [],
    'coalesce_tier': [],
    'cohort_split': [],
    'concordance_index': ['concordance_index'],
    'contract_engineering_dispositions': [],
    'contract_escalation_actions': [],
    'contract_profile': [],
    'contract_quality_holds': [],
    'coverage_snapshot': [],
    'cycle_features': ['soh_current', 'capacity_fade_rate', 'resistance_growth_rate', 'rolling_capacity_mean_10', 'rolling_temperature_max_10', 'rolling_resistance_mean_10', 'soh_delta_last_20_cycles', 'fast_charge_ratio', 'avg_depth_of_discharge', 'high_temp_exposure_hours', 'batch_failure_rate', 'station_anomaly_rate', 'remaining_cycles'],
    'dashboard_kpis': ['pct_high_critical', 'mean_predicted_soh'],
    'derive_failure_events': [],
    'dim_cell': [],
    'dim_lot': [],
    'dim_station': [],
    'dim_test_condition': ['test_temperature', 'charge_current', 'discharge_current'],
    'discharge_index': [],
    'discharge_remaining': [],
    'drift_by_cohort': ['probability_shift', 'soh_shift', 'alert_rate_shift'],
    'drift_table': ['reference_mean', 'current_mean', 'delta', 'psi'],
    'drift_worst_5': ['psi'],
    'driver_mix_flagged': [],
    'driver_mix_top8': [],
    'early_warning_features': ['soh_at_cycle_20', 'soh_at_cycle_50', 'capacity_fade_rate_50', 'resistance_growth_rate_50', 'resistance_mean_50', 'temperature_mean_50', 'temperature_max_50', 'voltage_min_50', 'test_temperature', 'charge_current', 'discharge_current', 'station_anomaly_rate'],
    'escalation_report': ['failure_probability', 'early_warning_probability', 'predicted_soh', 'predicted_remaining_cycles'],
    'escalation_required': [],
    'event_date': [],
    'event_mae': ['model_event_mae', 'baseline_event_mae'],
    'event_mae_baseline': ['baseline_event_mae'],
    'event_rates': ['capacity_drop_rate', 'impedance_spike_rate', 'thermal_anomaly_rate', 'early_degradation_rate'],
    'event_type': [],
    'expand_intervals': ['log_interval_end'],
    'export_lots_highest_risk': ['escalation_rate'],
    'export_stations_abnormal': ['thermal_anomaly_rate'],
    'export_urgent_escalations': ['failure_probability'],
    'exposure_band': [],
    'extract_escalation_queue': ['failure_probability', 'early_warning_probability', 'predicted_soh', 'predicted_remaining_cycles', 'last_soh', 'capacity_fade_rate', 'resistance_growth_rate', 'peak_temperature_max'],
    'extract_executive_health': ['last_soh', 'predicted_soh', 'predicted_remaining_cycles', 'failure_probability'],
    'extract_lot_quality': ['avg_final_soh', 'avg_capacity_fade_rate', 'avg_resistance_growth_rate', 'escalation_rate', 'early_degradation_rate', 'thermal_anomaly_rate', 'impedance_spike_rate'],
    'extract_root_cause': ['avg_capacity_fade_rate', 'avg_resistance_growth_rate', 'avg_failure_probability'],
    'fact_cycle_measurements': ['voltage_mean', 'voltage_min', 'voltage_max', 'current_mean', 'temperature_mean', 'temperature_max', 'discharge_capacity_ah', 'charge_capacity_ah', 'internal_resistance_mohm', 'energy_wh'],
    'fade_and_growth': ['capacity_fade_rate', 'resistance_growth_rate'],
    'failure_baseline': ['failure_probability'],
    'failure_baseline_top_10': ['event_risk'],
    'feature_profile': ['mean', 'std', 'min', 'max', 'p25', 'p50', 'p75'],
    'feature_soh_correlation': ['r'],
    'fleet_percentile': ['last_soh_pct', 'fade_pct', 'growth_pct', 'failure_probability_pct'],
    'holdout_by_group': ['event_rate', 'mean_probability', 'mean_abs_error'],
    'holdout_precision_by_group': ['average_precision'],
    'importance_top_n': ['importance'],
    'in_predicate': [],
    'initial_capacity': ['initial_capacity_ah', 'initial_resistance_mohm'],
    'jmp_cell_table': ['last_soh', 'predicted_soh', 'predicted_remaining_cycles', 'failure_probability', 'capacity_fade_rate', 'resistance_growth_rate', 'peak_temperature_max'],
    'last_charge_temp': ['last_charge_temp'],
    'latest_snapshot': ['soh_current', 'capacity_fade_rate', 'resistance_growth_rate', 'rolling_capacity_mean_10', 'rolling_temperature_max_10', 'rolling_resistance_mean_10', 'soh_delta_last_20_cycles', 'fast_charge_ratio', 'avg_depth_of_discharge', 'high_temp_exposure_hours', 'batch_failure_rate', 'station_anomaly_rate', 'remaining_cycles'],
    'leave_one_out_rate': ['batch_failure_rate', 'station_anomaly_rate'],
    'likely_root_cause': [],
    'load_facts': [],
    'lot_escalation_mean': ['escalation_rate'],
    'lot_station_final_soh': ['avg_final_soh'],
    'lot_station_heatmap': ['avg_final_soh'],
    'mart_cell_health_summary': ['last_soh', 'capacity_fade_rate', 'resistance_growth_rate', 'peak_temperature_max', 'predicted_soh', 'predicted_remaining_cycles', 'failure_probability', 'early_warning_probability'],
    'mart_escalation_queue': ['failure_probability', 'early_warning_probability', 'predicted_soh', 'predicted_remaining_cycles', 'last_soh', 'capacity_fade_rate', 'resistance_growth_rate', 'peak_temperature_max'],
    'mart_factory_quality': ['avg_final_soh', 'avg_capacity_fade_rate', 'avg_resistance_growth_rate', 'escalation_rate', 'early_degradation_rate', 'thermal_anomaly_rate', 'impedance_spike_rate'],
    'multi_key_sort': ['failure_probability', 'predicted_remaining_cycles'],
    'normalise_public_cycles': ['capacity_ah', 'soh', 'max_discharge_temp_c', 'max_charge_temp_c', 'discharge_temp_slope', 'voltage_slope'],
    'parse_raw_log': ['voltage', 'current', 'temperature'],
    'passfail_concentration': ['fail_rate'],
    'passfail_feature_means': ['mean'],
    'passfail_medians_iqr': ['median', 'iqr'],
    'peer_batch_average': ['batch_avg_soh', 'batch_avg_fade', 'batch_avg_res', 'batch_avg_fp'],
    'peer_signature': [],
    'permutation_importance': ['importance', 'spread'],
    'psi': ['psi'],
    'psi_status': [],
    'qc_cell_missing_features': [],
    'qc_duplicate_cell_cycle': [],
    'qc_escalation_missing_prediction': [],
    'qc_feature_without_cell': [],
    'qc_negative_resistance': [],
    'qc_null_discharge_capacity': [],
    'qc_orphan_cycle_cells': [],
    'qc_prediction_without_cell': [],
    'qc_soh_out_of_range': [],
    'qc_usage_without_cell': [],
    'quality_report': [],
    'quality_report_landing': [],
    'queue_by_tier': [],
    'queue_top_lots': [],
    'raw_log_health': [],
    'raw_log_reasons': [],
    'recent_cycle_window': ['start_soh', 'end_soh', 'soh_change', 'max_rolling_temperature'],
    'recommended_follow_up': [],
    'release_cutoff': [],
    'release_decision': ['score_f1', 'baseline_f1', 'earlier_recall', 'later_recall'],
    'release_split': [],
    'remaining_cycles': ['remaining_cycles'],
    'risk_by_usage': [],
    'risk_mix': [],
    'risk_tier': [],
    'roc_auc': ['roc_auc'],
    'rolling_10': ['rolling_capacity_mean_10', 'rolling_temperature_max_10', 'rolling_resistance_mean_10'],
    'rul_baseline_metrics': ['mae', 'rmse', 'r2'],
    'scan_factory': ['test_temperature', 'charge_current', 'discharge_current'],
    'scan_failure_events': [],
    'scan_landing_cycles': ['voltage_mean', 'voltage_min', 'voltage_max', 'current_mean', 'temperature_mean', 'temperature_max', 'discharge_capacity_ah', 'charge_capacity_ah', 'internal_resistance_mohm', 'energy_wh'],
    'scan_raw_log': [],
    'scan_usage': ['avg_depth_of_discharge', 'fast_charge_ratio', 'avg_daily_cycles', 'high_temp_exposure_hours', 'low_temp_exposure_hours'],
    'score_cells': ['predicted_soh', 'predicted_remaining_cycles', 'failure_probability', 'early_warning_probability'],
    'severity_counts': [],
    'severity_score': ['severity_score'],
    'signal_summary': ['max_temp_c', 'mean_temp_c', 'min_voltage_v', 'max_voltage_v', 'temp_slope', 'voltage_slope'],
    'soh_baseline_metrics': ['mae', 'rmse', 'r2'],
    'soh_box_by_usage': ['min', 'q1', 'median', 'q3', 'max'],
    'soh_current': ['soh_current'],
    'soh_delta_20': ['soh_delta_last_20_cycles'],
    'soh_vs_first': ['soh'],
    'station_anomaly_rate': ['station_anomaly_rate'],
    'stream_cycle_agg': ['mean_voltage', 'max_temperature'],
    'stream_score': ['predicted_soh'],
    'survival_distribution': ['predicted_expected_eol_cycle', 'event_probability_by_horizon', 'event_probability_by_500_cycles', 'predicted_remaining_cycles_from_observed'],
    'survival_frame': [],
    'survival_top_10': ['event_risk'],
    'temperature_summary': ['max_discharge_temp_c', 'max_charge_temp_c'],
    'threshold_table': ['threshold', 'precision', 'recall', 'cost'],
    'train_soh': ['mae', 'rmse', 'r2'],
    'validation_note': [],
}
