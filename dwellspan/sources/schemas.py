"""Schemas of the tables that a run keeps."""

from pyspark.sql import types as T



POLY = "array<struct<x:double,y:double>>"
BRAND = f"struct<name:string,paying:boolean,in_sponsor_list:boolean,score:double,ocr_text:string,ocr_conf:double,polys:array<{POLY}>,boxes_by_frame:map<string,array<{POLY}>>,frames:array<int>,frames_read:array<int>,instances:int,time_basis:string,source:string>"

DDL = {
    "manifest": "run string, created timestamp_ntz, updated timestamp_ntz, git string, video struct<path:string,fps:double,frames:bigint,width:int,height:int>, config map<string,string>, stats map<string,string>",
    "shots": "shot int, f_start int, f_end int, t_start double, t_end double, dur_s double, n_samples int, type string, purity double, band_conf double, band_bad_frac double, band_probes int, cut_severity double, carry_ok boolean, route string, qa boolean, reason string, partial boolean, frames array<int>",
    "detections": "frame int, t double, band string, band_size array<int>, H double, over int, band_line int, off_shift int, span array<int>, coef array<double>, segments array<struct<slope:double,intercept:double,x_lo:int,x_hi:int>>, knots array<array<double>>, fit_med double, local_clamp array<double>, conf double, conf_parts struct<span_ratio:double,fit_resid:double,slope_deg:double,bridged_frac:double,boundary_y:double,break_found:boolean,grass_below:double,band_grass:double>, strip array<int>, upscale double, rows array<struct<y0:int,h:int,w:int,x_off:int>>, shot int, route string",
    "creatives": f"creative int, n_frames int, seconds double, t_first double, t_last double, spans array<struct<a:double,b:double>>, rep_frame int, rep_band string, rep_conf double, frames array<int>, brands array<{BRAND}>, ocr_frames_read int, needs_llm boolean, llm_notes string",
    "states": "state int, creative int, shot int, t_first double, t_last double, n_frames int, seconds double, frames array<int>, mean_consec_dist double, status string",
    "annotations": f"shot int, frame int, t double, shot_type string, route string, qa boolean, empty boolean, boxes array<struct<brand:string,surface:string,poly:{POLY},bbox:array<int>,area_px:double>>",
    "exposure": f"t double, frame int, shot int, brand string, surface string, poly {POLY}, area_px double, area_frac double, occluded_frac double, visible_area_frac double, centrality double, clarity double, n_brands_in_frame int, source string, anchor_frame int, anchor_age_s double, conf double, fb_error_px double",
    "coverage": "t_start double, t_end double, dur_s double, shot int, status string, source string, conf double, reason string, advertiser string",
    "exposure_detail": "brand string, paying boolean, creative int, frame int, t double, seconds double, n_panels int, area_px double, area_pct double, dist_center double, area_source string, time_basis string, identified_by string, brightness double, brightness_rel double, surface string, covers_s double",
    "scan": f"frame int, t double, hits array<struct<brand:string,paying:boolean,text:string,ocr_conf:double,match:double,box:{POLY},area_px:double>>",
    "scan_llm": "`group` int, rep_frame int, rep_t double, members int, brands array<string>, notes string",
    "readings": "gid int, brands array<string>, `by` string, at timestamp_ntz, note string",
    "montage_index": "montage string, panels array<struct<gid:int,rep_t:double,members:int>>",
    "sponsors": "name string, aliases array<string>, paying boolean, note string",
    "truth": "brand string, seconds double",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])
